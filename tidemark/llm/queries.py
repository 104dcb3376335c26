"""Registered queries of the corpus operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import runtime
from tidemark.llm import bpe, toxicity
from tidemark.llm.common import table, text_of
from tidemark.llm.decontamination import contaminated
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.filter_audit import REPEATED, audit, failure_counts, text_filters
from tidemark.llm.hard_negatives import hard_negatives
from tidemark.llm.jaccard_join import similar_components
from tidemark.llm.licenses import scan
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.lm_scoring import score_texts
from tidemark.llm.resharding import reshard, write_layout
from tidemark.llm.token_files import read_tokens, write_tokens
from tidemark.llm.warc import page_report, read_archive, write_archive

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query(
    "op1_warc_archive",
    """
    WITH p AS (SELECT page_id, url, coalesce(html, '') h FROM pages),
    d AS (SELECT page_id, url, h, sha1(h) s, max(page_id) OVER (PARTITION BY h) AS last_id FROM p)
    SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
           array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + ((('0x' || substr(s, 1 + 10 * (i // 8)::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31)::INT, 1)), '') AS payload_digest,
           CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> last_id THEN last_id END AS refers_to, coalesce(url, '') AS target_uri
    FROM d
    """,
)
def op1_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = runtime.scratch_path(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path)
    return page_report(read_archive(spark, path))


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file; the package is looked up when a query needs it."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_bpe_automaton")
def op2_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = bpe.read_spec(vocabulary("word_bpe_49k.json"))
    texts = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), spec), spec)
    return texts.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


LINE_MIN_CHARS = 24
LINES_SQL = f"""
    lines AS (SELECT doc_id, p AS pos, raw, trim(raw, chr(32) || chr(9) || chr(13)) AS line
              FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS p FROM documents)),
    firsts AS (SELECT line, length(line) AS n, min(doc_id::HUGEINT * 2147483648 + pos) AS ord FROM lines WHERE line <> '' GROUP BY line),
    halves AS (SELECT line, n, ord, unnest([n, n + 1]) AS m FROM firsts WHERE n >= {LINE_MIN_CHARS}),
    keyed AS (SELECT line, ord, m, unnest(['h' || left(line, (m - 1) // 2), 't' || right(line, (m - 1) // 2)]) AS half FROM halves),
    near AS (SELECT DISTINCT b.line FROM keyed a JOIN keyed b ON a.half = b.half AND a.m = b.m AND a.ord < b.ord
             WHERE abs(length(a.line) - length(b.line)) <= 1 AND levenshtein(a.line, b.line) = 1),
    judged AS (SELECT l.*, f.ord IS NOT NULL AND f.ord <> doc_id::HUGEINT * 2147483648 + pos AS again,
                      f.ord IS NOT DISTINCT FROM doc_id::HUGEINT * 2147483648 + pos AND l.line IN (SELECT line FROM near) AS close
               FROM lines l LEFT JOIN firsts f ON l.line = f.line)
"""


@query(
    "op3_line_dedup",
    f"""
    WITH {LINES_SQL}
    SELECT doc_id, count(pos)::BIGINT AS n_lines, count(*) FILTER (again)::BIGINT AS n_repeated, count(*) FILTER (close)::BIGINT AS n_near,
           sha256(coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT again AND NOT close), '')) AS text_sha256
    FROM documents LEFT JOIN judged USING (doc_id) GROUP BY doc_id
    """,
)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs, min_chars=LINE_MIN_CHARS).select(
        "doc_id", F.col("__lines").cast("long").alias("n_lines"), F.col("__repeated").alias("n_repeated"), F.col("__near").alias("n_near"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


SEVERE = 0.5


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), split_severe=True)
    return toxicity.score(docs, model).withColumn("toxic", F.col("severity") >= SEVERE)


@query("op5_jaccard_join")
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(table(spark, sf_dir, "documents"), percent=90, size=3)


@query("op6_license_scan")
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["start"], s["end"])), ",")
    return scan(table(spark, sf_dir, "documents")).withColumn("spans", spans)


@query("op7_lm_scoring")
def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = bpe.read_spec(vocabulary("byte_bpe_50k.json"))
    return score_texts(table(spark, sf_dir, "documents"), spec, vocabulary=50_257, end_id=50_256)


@query("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = runtime.scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), bpe.read_spec(vocabulary("byte_bpe_50k.json")), path, end_id=2)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query(
    "op9_exact_dedup",
    r"""
    WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') t FROM documents)
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
           sha256(t) AS text_sha256
    FROM n WINDOW w AS (PARTITION BY t)
    """,
)
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


@query("op10_decontamination")
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OLD_SHARDS, NEW_SHARDS = 12, 16


@query("op11_resharding")
def op11_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    old = write_layout(docs, runtime.scratch_path(spark, "shards"), F.pmod(F.xxhash64("doc_id"), F.lit(OLD_SHARDS)))
    done = reshard(old, runtime.scratch_path(spark, "resharded"), NEW_SHARDS).read()
    return done.select(
        "doc_id", F.col("__size").alias("size"), F.crc32(text_of()).alias("text_crc32"), F.lit("bytes").alias("law"), F.col("__shard").alias("shard"),
        F.col("__slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("__from").alias("from_shard"),
    )


@query(
    "op12_hard_negatives",
    """
    WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
               FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
          FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
    p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
                 (row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id))::INT AS rank
          FROM p JOIN s ON p.anchor_id = s.anchor_id WHERE NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
    """,
)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), label=label)


@query(
    "op13_filter_audit",
    r"""
    WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                      list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
    m AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, list_filter([
              CASE WHEN len(ws) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' END,
              CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' END,
              CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
              CASE WHEN coalesce(d.doc_id > min(d.doc_id) OVER w, min(d.doc_id) OVER w IS NOT NULL) THEN 'E' END], lambda x: x IS NOT NULL) AS failed
          FROM d LEFT JOIN m ON d.doc_id = m.doc_id WINDOW w AS (PARTITION BY t)),
    c AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, failed),
    l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    p AS (SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    s AS (SELECT o, unnest(range(1, 6))::INT AS step FROM p),
    r AS (SELECT part, array_to_string(o, '') AS filter_order, step, o[step] AS f,
                 sum(CASE WHEN NOT list_has_any(failed, o[1:step]) THEN n ELSE 0 END)::BIGINT AS kept,
                 sum(CASE WHEN list_contains(failed, o[step]) AND NOT list_has_any(failed, o[1:step - 1]) THEN n ELSE 0 END)::BIGINT AS removed,
                 sum(CASE WHEN list_contains(failed, o[step]) AND list_has_any(failed, o[1:step - 1]) THEN n ELSE 0 END)::BIGINT AS redundant,
                 sum(CASE WHEN failed = [o[step]] THEN n ELSE 0 END)::BIGINT AS unique_fails,
                 sum(CASE WHEN list_contains(failed, o[step]) AND NOT list_has_any(failed, o[1:step - 1]) THEN good ELSE 0 END)::BIGINT AS good_lost,
                 sum(CASE WHEN list_contains(failed, o[step]) AND NOT list_has_any(failed, o[1:step - 1]) THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
          FROM c, s GROUP BY part, o, step)
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
           (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM r
    """,
)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    filters = text_filters()
    counts = failure_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), filters)
    return audit(counts, [*filters, REPEATED])
