"""The corpus pipeline: documents in, sharded training mix out.

Each stage takes the documents its predecessor kept, decides over all of them,
and is written before the next one reads it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.decontaminate import drop_contaminated
from daybook.llm.grading import grades_of, keep_good
from daybook.llm.mixing import take
from daybook.llm.queries import SHARDS, table
from daybook.llm.sharding import shard
from daybook.llm.simhash import keep_one_of_each
from daybook.workspace import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier does not reject."""
    ratings = grades_of(table(spark, sf_dir, "labels"), F.col("quality"), F.col("toxic"))
    return keep_good(docs, ratings)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return keep_one_of_each(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return take(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A shard and a slot for every row of the mix."""
    assigned = shard(docs, SHARDS, keep=("lang", "source", "n_chars"))
    return assigned.select("doc_id", "lang", "source", "n_chars", "size", "text_crc32", "shard", "slot")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# The classifier and the random rounding have no SQL form; the tests hold every
# stage against what it has to keep.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    last = len(STAGES) - 1
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < last:
            docs = materialize(docs, name.replace(" ", "-"))
    return docs
