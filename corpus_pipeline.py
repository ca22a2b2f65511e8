"""The corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before
it kept, and is written as Parquet before the next one reads it. All but the
last return the columns of ``documents``, whatever other columns it has. An
empty table passes through every stage; ids may be null or repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import discard, materialize, table, text_of
from granary.llm.decontamination import decontaminate
from granary.llm.jaccard_join import near_duplicates, split_by_mention
from granary.llm.packing import pack
from granary.llm.pii import redact
from granary.llm.quality_rules import judge_quality, trusted_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the quality rules keep: null, empty and short texts go, equal rows are judged alike."""
    judged = judge_quality(docs, trusted_documents(table(spark, sf_dir, "labels")), keep_columns=True)
    return judged.filter("kept").select("row.*")


def near_duplicate_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates: that of the smallest id, a null id last, and the first of equal ids.

    Ids may be null or repeat, so groups are formed of texts, by a hash; of rows
    with the same id and text one stays. Null and empty texts all stay.
    """
    marked = docs.select("doc_id", "text", F.xxhash64(text_of()).alias("_t"), F.struct("*").alias("row"))
    groups = near_duplicates(marked, id_column="_t").filter("n_shingles > 0")
    groups = materialize(groups.select(F.col("doc_id").alias("_t"), "component_id").distinct(), "groups")
    rows = materialize(marked.select("doc_id", "_t", F.monotonically_increasing_id().alias("place")), "rows")
    keys = rows.groupBy("doc_id", "_t").agg(F.count("*").alias("n"), F.min("place").alias("place")).join(groups, "_t")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "place", "_t")
    first = keys.groupBy("component_id").agg(F.min(order).alias("s")).select("s.place")
    # Of a key: 0, its rows go; 1, one of its several rows stays. Other rows stay as they are.
    status = keys.join(first.withColumn("one", F.lit(1)), "place", "left").filter("one IS NULL OR n > 1")
    status = materialize(status.select("doc_id", "_t", F.coalesce("one", F.lit(0)).alias("one")), "status")
    discard(groups, rows)
    stay, doubtful = split_by_mention(marked.select("doc_id", "_t", "row"), status, ["doc_id", "_t"])
    same = doubtful["doc_id"].eqNullSafe(status["doc_id"]) & (doubtful["_t"] == status["_t"])
    known = doubtful.join(status, same, "left").select(doubtful["doc_id"], doubtful["_t"], "row", "one").filter("one IS NULL OR one = 1")
    apart = F.when(F.col("one") == 1, F.lit(-1)).otherwise(F.monotonically_increasing_id())
    chosen = known.withColumn("apart", apart).dropDuplicates(["doc_id", "_t", "apart"])
    return stay.select("row.*").unionByName(chosen.select("row.*"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold no passage of the benchmark; null and empty texts stay, and all where it has no items."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by its kind; a null text stays null, and n_chars follows the text."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of token sequences that hold the documents; a null or empty text is its end token alone."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicate_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii", personal_data),
    ("packing", packing),
]

#: SQL can express neither the likelihood ratio's token classes nor tokenizing and packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, before = materialize(stage(spark, docs, sf_dir), name), docs
        discard(before)
    return docs
