"""Corpus pipeline over ``documents``: five stages of the dealt operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's result as Parquet in the shared folder and reads it back as the
next stage's ``docs``.  All but the last return the columns of documents.
Rows are judged by their text, whatever their id: null and repeated ids do not
share a fate, equal texts do, and the Jaccard stage keeps one row of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayscope.llm import decontaminate, jaccard_rtree, langid, mixing, suffix_dedup
from stayscope.llm.store import stored
from stayscope.session import remove_written, written_so_far

MAX_BITS_PER_BYTE = 8.0      # a text that no language codes better than raw bytes is rejected
SHINGLE, PERCENT = 5, 80     # near copies: Jaccard similarity of five-word shingles
MIN_BYTES = 32               # shorter texts say too little to be rejected by their code length


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no text, no letter, or a code
    length under every language's tree above that of raw bytes.  A prediction
    depends on the text alone and carries its row: no text is shuffled."""
    whole = docs.select("text", F.struct(*docs.columns).alias("row"))
    out = langid.predict(whole, langid.train(docs, "doc_id", "text", "lang"), "row")
    return out.where(~((F.col("lang_pred") == langid.UND) |
                       ((F.col("bits_per_byte") > MAX_BITS_PER_BYTE) & (F.col("n_bytes") >= MIN_BYTES)))).select("row.*")


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component, of those with the least id."""
    return jaccard_rtree.one_per_component(docs, k=SHINGLE, percent=PERCENT)


def suffix_array(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated 200-byte strings from the texts; every document stays."""
    return suffix_dedup.without_repeats(docs).withColumn(
        "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: per document the words taken, the shard of each draw and the text."""
    mixed = mixing.mix(docs, carry=["lang", "text"])
    return mixed.select("doc_id", "lang", "text", "source", "size", "source_size", "target",
                        (F.size("draws") * F.col("size")).cast("long").alias("taken"),
                        F.col("draws")["shard"].alias("shards"))


STAGES = [
    ("language_id", language_id),
    ("jaccard_join", jaccard_join),
    ("suffix_array", suffix_array),
    ("decontamination", decontamination),
    ("mix_sources", mix_sources),
]

#: PPM scores, suffix sorting and the hash-ordered mix have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = written_so_far()
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        remove_written(spark, before, keep=docs)        # the stage's own tables and its input
    return docs
