"""Token ids in compressed binary files: one wavelet matrix per shard.

A shard holds the ids of neighbouring documents as bit planes, the highest bit first; each plane stands in the order in
which the planes above have stably split the tokens, zeros before ones. With counts of ones per block of a plane, any
token, the number of occurrences of an id before a place, and the place of its n-th occurrence are found without
unpacking the shard.

File layout (little-endian): magic, 8-bit number of planes, then 64-bit numbers of documents and tokens; deflated and
each preceded by its 64-bit length: document identifiers, a byte per document that is 1 where it has none, tokens per
document, and the planes.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import byte_letters
from tidemark.llm.common import bounded_batches, text_of, together, worker_slot

MAGIC = b"WVM1"
BLOCK = 512
# A shard is closed when it has so many tokens; a longer document is a shard of its own.
SHARD_TOKENS = 1 << 18
# Stretches remembered by a Python worker, in each of two generations.
CACHED = 500_000
CACHED_CHARS = 64
# Texts encoded together: so many bytes, or one batch.
PIECES_BYTES = 8 << 20
# Marks the first stretch of a text; white space that is neither a blank nor a line end, and what Python takes for it.
FIRST = "\0"
SIGNS = ".,!?;:#$%&*|"
# Up to here Python and the library agree on which signs are letters.
LAST_LETTER = "\u024f"
SPACES = tuple("\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000") + tuple(chr(c) for c in range(0x2000, 0x200B))


class WaveletMatrix:
    """Planes of one sequence of unsigned ids."""

    def __init__(self, n: int, planes: list[np.ndarray]) -> None:
        self.n, self.planes = n, planes
        self.zeros, self.before = [], []
        for plane in planes:
            ones = np.bitwise_count(np.pad(plane, (0, -len(plane) % (BLOCK // 8)))).reshape(-1, BLOCK // 8).sum(1, dtype=np.int64)
            self.before.append(np.concatenate([[0], np.cumsum(ones)]))
            self.zeros.append(n - int(self.before[-1][-1]))

    @classmethod
    def build(cls, ids: np.ndarray, levels: int) -> WaveletMatrix:
        planes, rest = [], ids.astype(np.uint16 if levels <= 16 else np.uint32)
        for level in range(levels - 1, -1, -1):
            bit = (rest & (1 << level)) != 0
            planes.append(np.packbits(bit, bitorder="little"))
            rest = np.concatenate([rest.take(np.flatnonzero(~bit)), rest.take(np.flatnonzero(bit))])
        return cls(len(ids), planes)

    def _bit(self, level: int, at: int) -> int:
        return int(self.planes[level][at >> 3] >> (at & 7) & 1)

    def _ones(self, level: int, at: int) -> int:
        """Ones before a place of a plane."""
        block = at // BLOCK
        whole, rest = self.planes[level][block * BLOCK // 8 : at >> 3], at & 7
        count = int(self.before[level][block]) + int(np.bitwise_count(whole).sum(dtype=np.int64))
        return count + (int(self.planes[level][at >> 3] & ((1 << rest) - 1)).bit_count() if rest else 0)

    def access(self, at: int) -> int:
        """The id at a place."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        value = 0
        for level, zeros in enumerate(self.zeros):
            bit, ones = self._bit(level, at), self._ones(level, at)
            value, at = value << 1 | bit, zeros + ones if bit else at - ones
        return value

    def _range(self, token: int, end: int) -> tuple[int, int]:
        if token >> len(self.planes):
            return 0, 0
        start = 0
        for level, zeros in enumerate(self.zeros):
            a, b = self._ones(level, start), self._ones(level, end)
            start, end = (zeros + a, zeros + b) if token >> (len(self.planes) - 1 - level) & 1 else (start - a, end - b)
        return start, end

    def count(self, token: int, end: int | None = None) -> int:
        """Occurrences of an id before a place, or in all."""
        start, stop = self._range(token, self.n if end is None else end)
        return stop - start

    def _select(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th one (or zero) of a plane, from 0."""
        ones = self.before[level]
        counts = ones if bit else np.minimum(np.arange(len(ones)) * BLOCK, self.n) - ones
        block = int(np.searchsorted(counts, k, side="right")) - 1
        part = self.planes[level][block * BLOCK // 8 : (block + 1) * BLOCK // 8]
        return block * BLOCK + int(np.flatnonzero(np.unpackbits(part, bitorder="little") == bit)[k - int(counts[block])])

    def find(self, token: int, k: int) -> int:
        """Place of the k-th occurrence of an id, from 0."""
        start, stop = self._range(token, self.n)
        if not 0 <= k < stop - start:
            raise IndexError(k)
        at = start + k
        for level in range(len(self.planes) - 1, -1, -1):
            bit = token >> (len(self.planes) - 1 - level) & 1
            at = self._select(level, bit, at - self.zeros[level] if bit else at)
        return at

    def ids(self) -> np.ndarray:
        """All ids in order, by undoing the splits from the last plane up."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        values = np.zeros(self.n, kind)
        for level in range(len(self.planes) - 1, -1, -1):
            bit = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            merged = np.empty_like(values)
            merged[np.flatnonzero(~bit)] = values[: self.zeros[level]]
            merged[np.flatnonzero(bit)] = values[self.zeros[level] :] | kind(1 << (len(self.planes) - 1 - level))
            values = merged
        return values.astype(np.uint32)


def deflated(data: bytes) -> bytes:
    """Planes have runs but hardly repeats: looking for runs only is faster and packs them closer."""
    packer = zlib.compressobj(1, strategy=zlib.Z_RLE)
    return packer.compress(data) + packer.flush()


class Shard:
    """One file: documents and their ids."""

    def __init__(self, doc_ids: list[int | None], lengths: np.ndarray, matrix: WaveletMatrix) -> None:
        self.doc_ids, self.lengths, self.matrix = doc_ids, lengths, matrix

    @classmethod
    def build(cls, doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, levels: int) -> Shard:
        return cls(doc_ids, np.array(lengths, np.int64), WaveletMatrix.build(ids, levels))

    def to_bytes(self) -> bytes:
        keys = np.array([0 if i is None else i for i in self.doc_ids], "<i8")
        missing = np.array([i is None for i in self.doc_ids], np.uint8)
        parts = [keys, missing, self.lengths.astype("<i8"), *self.matrix.planes]
        out = [MAGIC, struct.pack("<BQQ", len(self.matrix.planes), len(self.doc_ids), self.matrix.n)]
        for part in parts:
            packed = deflated(part.tobytes())
            out += [struct.pack("<Q", len(packed)), packed]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, data: bytes) -> Shard:
        if data[:4] != MAGIC:
            raise ValueError("not a token shard")
        levels, _, n = struct.unpack_from("<BQQ", data, 4)
        at, parts = 21, []
        for _ in range(3 + levels):
            (size,) = struct.unpack_from("<Q", data, at)
            parts.append(zlib.decompress(data[at + 8 : at + 8 + size]))
            at += 8 + size
        missing = np.frombuffer(parts[1], np.uint8)
        ids = [None if m else int(i) for i, m in zip(np.frombuffer(parts[0], "<i8"), missing)]
        return cls(ids, np.frombuffer(parts[2], "<i8"), WaveletMatrix(n, [np.frombuffer(p, np.uint8) for p in parts[3:]]))


class PieceEncoder:
    """Encoding by the tokenizers library, which sees a stretch without white space once while it is remembered.

    Merges never cross from one stretch, with the blank or line end before it, to the next. Texts with special tokens,
    or with white space other than single blanks and line ends, go to the library whole. A stretch of letters only is one
    word to the library's splitting, so it goes to the library's model at once.
    """

    def __init__(self, spec: bytes) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec.decode())
        self.library.no_padding()
        self.library.no_truncation()
        made = json.loads(spec)
        # Whether words are what GPT-2's expression makes of the text as it is, in letters that stand for bytes.
        split = made.get("pre_tokenizer") or {}
        self.by_words = made.get("normalizer") is None and split.get("type") == "ByteLevel" and not split.get("add_prefix_space", True) and split.get("use_regex", True)
        self.model = self.library.model
        self.letters = {b: c for c, b in byte_letters().items()}
        self.line_end = self._ids(["\n"])[0]
        self.whole = (*[t.content for t in self.library.get_added_tokens_decoder().values()], "  ", "\n\n", " \n", "\n ", FIRST, *SPACES)
        # Two generations: what is still used when the younger is full moves on, the rest is forgotten.
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def _word(self, piece: str) -> bytes | None:
        """Ids of a piece whose signs are letters, after a blank, after a line end or first in its text; None for others."""
        lead = piece[0:1]
        word = piece[1:] if lead == "\n" or lead == FIRST else piece
        if not self.by_words or not word.isalpha():
            return None
        before = " " if word is piece else ""
        if word.isascii():
            word = self.letters[32] + word if before else word
        elif max(word) <= LAST_LETTER:
            word = (before + word).encode().decode("latin-1").translate(self.letters)
        else:
            return None
        ids = array("I", [t.id for t in self.model.tokenize(word)]).tobytes()
        return self.line_end + ids if lead == "\n" else ids

    def _look_up(self, wanted: set[str]) -> dict[str, bytes]:
        """Ids of pieces that the younger generation does not have."""
        got: dict[str, bytes] = {}
        parts: dict[str, tuple[str, str]] = {}
        new: list[str] = []
        old, tokenize, blank, by_words = self.old.get, self.model.tokenize, self.letters[32], self.by_words

        def find(p: str) -> None:
            # Most pieces are words of ASCII letters after a blank: they go to the model from here.
            if by_words and p.isascii() and p.isalpha():
                got[p] = array("I", [t.id for t in tokenize(blank + p)]).tobytes()
            elif (ids := self._word(p)) is not None:
                got[p] = ids
            else:
                new.append(p)

        for p in wanted:
            if (ids := old(p)) is not None:
                got[p] = ids
            elif p[-1:] in SIGNS and (word := p.rstrip(SIGNS))[-1:].isalpha() and word[-1] <= LAST_LETTER:
                # Signs after a letter are pieces of their own, so a word is looked up without them.
                parts[p] = word, FIRST + p[len(word) :]
            else:
                find(p)
        for q in {q for pair in parts.values() for q in pair}:
            if q not in got and q not in self.young and q not in wanted:
                if (ids := old(q)) is not None:
                    got[q] = ids
                else:
                    find(q)
        # A piece stands after a blank, unless it is a text's first or begins with a line end.
        got.update(zip(new, self._ids([p[1:] if p[0:1] == FIRST else p if p[0:1] == "\n" else " " + p for p in new])))
        for p, pair in parts.items():
            word, signs = pair
            got[p] = (got[word] if word in got else self.young[word]) + (got[signs] if signs in got else self.young[signs])
        return got

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut: list[str] = []
        ends, whole = [], {}
        count = 0
        # What is in none of the texts is looked for once.
        every = FIRST.join(texts)
        signs = [x for x in self.whole if x != FIRST and x in every] + [FIRST]
        for k, text in enumerate(texts):
            if any(x in text for x in signs):
                whole[k] = text
            elif text:
                cut.append(FIRST + text.replace("\n", " \n"))
                count += 1 + text.count(" ") + text.count("\n")
            ends.append(count)
        ids, places = self._joined(" ".join(cut)) if cut else (np.zeros(0, "<u4"), np.zeros(1, np.int64))
        direct = dict(zip(whole, self._ids(list(whole.values())))) if whole else {}
        out, start = [], 0
        for k, end in enumerate(ends):
            out.append(direct[k] if k in direct else ids[places[start] : places[end]].tobytes())
            start = end
        return out

    def _joined(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces between the blanks of a text, and where each piece's begin and the last one's end.

        Every different piece is looked up once, and its ids are taken as often as it is there.
        """
        pieces = pc.split_pattern(pa.array([text], pa.large_string()), " ").values.dictionary_encode()
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.young.get, distinct))
        if None in found:
            got = self._look_up({p for p, x in zip(distinct, found) if x is None})
            found = [got[p] if x is None else x for p, x in zip(distinct, found)]
            if len(self.young) + len(got) > CACHED:
                self.old, self.young = self.young, {}
            if len(got) <= CACHED:
                self.young.update(got)
                for p in [p for p in got if len(p) > CACHED_CHARS]:
                    del self.young[p]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        which = pieces.indices.to_numpy()
        taken = sizes[which]
        places = np.concatenate([[0], np.cumsum(taken)])
        at = np.repeat((np.cumsum(sizes) - sizes)[which] - places[:-1], taken)
        at += np.arange(len(at))
        return np.frombuffer(b"".join(found), "<u4")[at], places


def piece_encoder(spec: bytes) -> PieceEncoder:
    return worker_slot("token files", hash(spec), lambda: PieceEncoder(spec))


def write_tokens(docs: DataFrame, spec: bytes, path: str, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the ids of all texts in ascending identifier order as shards, each the ``file`` of one row below ``path``.

    ``part, seq`` order the shards, ``before`` counts the ids of the shards before it in its part. Null texts count as empty; rows without an identifier come last; rows that share one
    stay next to each other. ``end_id`` is appended to each document unless None. Other columns are not read.
    """
    bounded_batches(docs.sparkSession)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = piece_encoder(spec)
        levels = max(1, max(own.library.get_vocab_size() - 1, end_id or 0).bit_length())
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        part, seq = TaskContext.get().partitionId(), 0
        keys: list[int | None] = []
        held: list[bytes] = []
        tokens = before = 0

        def closed() -> pa.RecordBatch:
            lengths = [len(x) // 4 for x in held]
            shard = Shard.build(list(keys), lengths, np.frombuffer(b"".join(held), "<u4"), levels).to_bytes()
            row = [[part], [seq], [len(keys)], [tokens], [before], [shard]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.record_batch([pa.array(x, k) for x, k in zip(row, kinds)], names=["part", "seq", "docs", "tokens", "before", "file"])

        for some in together(batches, PIECES_BYTES):
            for key, ids in zip((i for b in some for i in b.column(0).to_pylist()), own.encode([t for b in some for t in b.column(1).to_pylist()])):
                if held and tokens + len(ids) // 4 > shard_tokens:
                    yield closed()
                    seq, before, tokens = seq + 1, before + tokens, 0
                    keys.clear()
                    held.clear()
                keys.append(key)
                held.append(ids + end)
                tokens += len(held[-1]) // 4
        if held:
            yield closed()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    rows = rows.repartitionByRange(F.col("id").asc_nulls_last()).sortWithinPartitions(F.col("id").asc_nulls_last())
    rows.mapInArrow(shards, "part int, seq int, docs long, tokens long, before long, file binary").write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """``id_col, start, n_tokens, ids``: each document of the files, the number of ids before it, and its ids."""
    bounded_batches(spark)
    files = spark.read.parquet(path)
    # One row per writing task: the table is bounded by the number of partitions.
    parts = files.groupBy("part").agg(F.sum("tokens").alias("of_part"))
    parts = parts.select("part", (F.sum("of_part").over(Window.orderBy("part")) - F.col("of_part")).alias("before_part"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard = Shard.from_bytes(data.as_py())
                ends = np.cumsum(shard.lengths)
                ids = shard.matrix.ids().astype("<u4", copy=False)
                places = np.append(0, 4 * ends).astype(np.int32)
                for a in range(0, len(ends), 256):
                    b = min(a + 256, len(ends))
                    firsts = (ends - shard.lengths)[a:b]
                    cut = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(places[a : b + 1]), pa.py_buffer(ids)])
                    yield pa.record_batch(
                        [pa.array(shard.doc_ids[a:b], pa.int64()), pa.array(firsts + start), pa.array(shard.lengths[a:b]), cut],
                        names=[id_col, "start", "n_tokens", "ids"],
                    )

    placed = files.join(F.broadcast(parts), "part").select((F.col("before_part") + F.col("before")).alias("start"), "file")
    return placed.mapInArrow(documents, f"`{id_col}` long, start long, n_tokens long, ids binary")
