"""BPE encoding and decoding with a tokenization automaton.

The automaton accepts exactly the token sequences that the merges can produce. It starts as one state with a loop for
every base symbol; the merges are then put in one after another. The gadget of a merge (u, v): every arc u that leads to
a state with an arc v is led to a copy of that state without it, and an arc uv is added that goes where u, v went.

All arcs of one token lead to one state, so a state is kept as the map of the arcs it has lost and when; a copy copies
that map. An arc uv is there if the arc u was there when uv was made and uv has not been lost since. Encoding runs the
automaton over the bytes of a word, whose accepted token sequence is unique. Decoding
emits the labels of the arcs.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, text_of, worker_slot

START = 0
# Words and whitespace-free pieces remembered by a Python worker; beyond this number they are forgotten and met again.
CACHED = 250_000
CACHED_CHARS = 64
MARGIN = "</w>"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Separators that Python's str.split() takes for white space and the pattern does not.
CONTROLS = regex.compile("[\x1c-\x1f]")
PIECES = regex.compile("[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in a vocabulary: printable ones for themselves, the others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """Token automaton of a list of merges."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]) -> None:
        n = 1 + max(vocab.values(), default=-1)
        self.goal = [START] * n  # the state all arcs of a token lead to
        self.lost: list[dict[int, int]] = [{}]  # by state: tokens without an arc, and since which merge
        self.left = [-1] * n
        self.born = [-1] * n
        self.dead = bytearray(n)
        users = [n + 1]  # the start state itself never changes
        for at, (a, b) in enumerate(merges):
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            state, after = self.goal[u], self.goal[v]
            self.left[w], self.born[w] = u, at
            if not self.arc(state, v):
                self.dead[w] = 1
                continue
            self.goal[w] = after
            users[after] += 1
            if users[state] > 1:
                users[state] -= 1
                self.lost.append(dict(self.lost[state]))
                users.append(1)
                state = self.goal[u] = len(self.lost) - 1
            self.lost[state][v] = at
        self.table: dict[int, bool] = {}

    def arc(self, state: int, token: int) -> bool:
        """Whether the state has an arc of the token."""
        lost, left, born = self.lost[state], self.left, self.born
        if token in lost or self.dead[token]:
            return False
        while (u := left[token]) >= 0:
            since = lost.get(u)
            if since is not None and since <= born[token]:
                return False
            token = u
        return True

    def step(self, state: int, token: int) -> bool:
        """``arc`` from the table of transitions met so far."""
        key = state << 20 | token
        known = self.table.get(key)
        if known is None:
            if len(self.table) > 500_000:
                self.table.clear()
            known = self.table[key] = self.arc(state, token)
        return known


class Encoder:
    """Texts to token ids and back, as set by the JSON of a tokenizer with word ends."""

    def __init__(self, spec: bytes) -> None:
        made = json.loads(spec)
        vocab = made["model"]["vocab"]
        self.automaton = Automaton(vocab, [tuple(m) for m in made["model"]["merges"]])
        letters = byte_letters()
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        for token, i in vocab.items():
            end = token.endswith(MARGIN)
            text = token[: -len(MARGIN)] if end else token
            (self.final if end else self.inner)[bytes(letters[c] for c in text)] = i
        self.longest = max(map(len, [*self.inner, *self.final]), default=1)
        added = {t["content"]: t["id"] for t in made["added_tokens"]}
        self.labels = np.empty(1 + max([*vocab.values(), *added.values()]), object)
        for token, i in [*vocab.items(), *added.items()]:
            self.labels[i] = token
        self.added = {t: np.uint32(i).tobytes() for t, i in added.items()}
        self.marks = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.words = regex.compile(WORDS)
        self.of_word: dict[str, bytes] = {}
        # Two generations of stretches: what is still used when the younger is full moves on.
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def word(self, word: str) -> bytes:
        """Ids of one word: arcs over its bytes from the start state, the longest label first.

        Accepted sequences are unique, so a place that was left again is never on the way.
        """
        data = word.encode("utf-8", "surrogatepass")
        n, step, goal, longest = len(data), self.automaton.step, self.automaton.goal, self.longest
        at, state, end = 0, START, min(len(data), longest)
        out: list[int] = []
        came: list[tuple[int, int, int]] = []
        left: set[int] = set()
        while at < n:
            while end > at:
                token = (self.final if end == n else self.inner).get(data[at:end])
                if token is not None and end not in left and step(state, token):
                    break
                end -= 1
            else:
                left.add(at)
                if not came:
                    raise ValueError(f"the vocabulary has no tokens for {word[:40]!r}")
                at, state, end = came.pop()
                out.pop()
                end -= 1
                continue
            came.append((at, state, end))
            out.append(token)
            at, state, end = end, goal[token], min(n, end + longest)
        return np.array(out, np.uint32).tobytes()

    def piece(self, piece: str) -> bytes:
        """Ids of a stretch without white space."""
        out = []
        for word in self.words.findall(piece):
            ids = self.of_word.get(word)
            if ids is None:
                ids = self.word(word)
                if len(word) <= CACHED_CHARS:
                    if len(self.of_word) >= CACHED:
                        self.of_word.clear()
                    self.of_word[word] = ids
            out.append(ids)
        return b"".join(out)

    def known(self, pieces: list[str]) -> list[bytes]:
        """Ids of each stretch, from those remembered where possible."""
        found = list(map(self.young.get, pieces))
        if None in found:
            for k, ids in enumerate(found):
                if ids is None:
                    piece = pieces[k]
                    ids = self.young.get(piece) or self.old.get(piece) or self.piece(piece)
                    if len(piece) <= CACHED_CHARS:
                        self.young[piece] = ids
                    found[k] = ids
            if len(self.young) > CACHED:
                self.old, self.young = self.young, {}
        return found

    def pieces(self, text: str) -> list[str]:
        """Normalised stretches without white space."""
        # Letter by letter: a sigma at the end of a word has no form of its own here.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return PIECES.findall(text) if CONTROLS.search(text) else text.split()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out = []
        for k, part in enumerate(self.marks.split(text) if self.marks else [text]):
            if k % 2:
                out.append(self.added[part])
                continue
            out += self.known(self.pieces(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Labels of the arcs, with blanks between them."""
        return " ".join(self.labels[np.frombuffer(ids, "<u4")])


def encoder(spec: bytes) -> Encoder:
    """The encoder of a specification, built once in each Python worker."""
    return worker_slot("bpe", hash(spec), lambda: Encoder(spec))


def read_spec(path: str) -> bytes:
    """The vocabulary file, read by the driver and sent with the tasks (a few MB)."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, spec: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids``: token ids of each row's whole text as little-endian unsigned 32-bit integers.

    A null or empty text has no ids. Every row gives a row, also with a null or repeated identifier. Other columns are
    not read.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(spec)
        for batch in batches:
            ids = [own.encode(t) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.binary())], names=[id_col, "ids"])

    rows = docs.select(F.col(id_col), text_of(text_col).alias("text"))
    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, ids binary")


def decode(tokens: DataFrame, spec: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, ids, text``: the decoded text of each row; null ids decode to the empty text."""
    bounded_batches(tokens.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(spec)
        for batch in batches:
            texts = [own.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=[id_col, "ids", "text"])

    rows = tokens.select(F.col(id_col), F.coalesce(F.col(ids_col), F.lit(b"").cast("binary")).alias("ids"))
    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, ids binary, text string")
