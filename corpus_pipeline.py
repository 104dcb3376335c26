"""The corpus pipeline: toxic documents go, then repeated lines, near copies and benchmark passages; the rest is encoded.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table that is written as Parquet and read again as the next
stage's documents. All but the last keep the columns of ``documents``, also ones that are not named here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, toxicity
from tidemark.llm.common import stored, table
from tidemark.llm.decontamination import clean
from tidemark.llm.jaccard_join import similar_components
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.queries import LINE_MIN_CHARS, SEVERE, vocabulary

# Near copies: shingles of five words, similarity in percent.
SHINGLE, SIMILAR = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity is below the limit; the model is trained on the labelled ones of ``docs``."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), split_severe=True)
    return toxicity.reject(docs, model, SEVERE)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that stand earlier already; a document that loses all its lines goes. ``n_chars`` follows."""
    done = line_dedup(docs, min_chars=LINE_MIN_CHARS)
    gone = F.col("__repeated") + F.col("__near")
    done = done.filter((gone == 0) | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        done = done.withColumn("n_chars", F.when(gone > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return done.select(*docs.columns)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents that with the smallest identifier; rows without one stay."""
    groups = stored(similar_components(docs, percent=SIMILAR, size=SHINGLE), "similar")
    gone = groups.filter(F.col("doc_id").isNotNull() & (F.col("doc_id") != F.col("component_id"))).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == F.col("__gone"), "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark questions, also in other words for their names, numbers and units."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, ids``: the token ids of what is left."""
    tokens = bpe.encode(docs, bpe.read_spec(vocabulary("word_bpe_49k.json")))
    return tokens.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), "ids")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("jaccard_join", keep_one_of_similar),
    ("decontamination", drop_contaminated),
    ("bpe", encode_documents),
]
# A trained model and token ids are beyond SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each on the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
