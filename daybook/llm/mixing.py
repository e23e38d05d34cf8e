"""Mixing sources to target weights by pivotal dependent rounding.

Sources in code-point order, null last, weigh `weights` in turn. Each gets its
share of the wanted total; none gets more than `max_repeat` times its own size,
and what is over goes to the others by weight. A document of a source is then
due `target / source size` copies: the whole part is certain, the rest is a
copy with a probability.

Those probabilities are rounded together, source by source. Two documents hold
fractional mass (probability times size); a random transfer, fair on average,
moves mass from one to the other until one of them has probability 0 or 1. The
taken words of a source therefore stay at its target, up to the one document
left over at the end. Documents are rounded in buckets, each leaves at most one
fractional document, and these residuals go up a tree of buckets.

Randomness comes from hashes of seed, id and text, so reruns agree. Null text
has size 0; documents of size 0 are taken 0 words. Repeated rows are rounded
each on its own. An empty table gives an empty result. Null ids are like others.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.rows import SPACE, column, numbered, unused
from daybook.operators.surrogate import with_surrogate_key
from daybook.workspace import materialize

BUCKET_ROWS = 2000
FAN_IN = 64
_ROUNDED = "row_id long, p double"


def n_words(text: Column) -> Column:
    """Number of runs of characters that are not ASCII white space."""
    return F.coalesce(
        F.size(F.array_remove(F.split(text, SPACE), "")), F.lit(0)
    ).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0, max_repeat: float = 3.0
) -> DataFrame:
    """`source`, `source_size`, `target` from one row per source.

    A source is at its bound when the level (words for each unit of weight)
    exceeds ``max_repeat * size / weight``. Sources at their bound raise the
    level of the others; a few sums find the level at which nothing changes.
    """
    order = [F.col("source").isNull(), F.col("source")]
    listed = F.array(*(F.lit(float(w)) for w in weights))
    ranked = materialize(
        with_surrogate_key(sizes, 0, order).withColumn(
            "weight", F.element_at(listed, (F.col("id") % len(weights)).cast("int") + 1)
        ),
        "sources",
    )
    bound = max_repeat * F.col("source_size")
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0
    while True:
        full = bound < F.lit(level) * F.col("weight")
        at_bound, free = ranked.agg(
            F.sum(F.when(full, bound).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        if not free:
            break
        raised = (total - at_bound) / free
        if raised <= level:
            break
        level = raised
    return ranked.select("source", "source_size", F.least(bound, F.lit(level) * F.col("weight")).alias("target"))


def _pivot(rows: pd.DataFrame) -> pd.DataFrame:
    """Round a bucket: every probability but one becomes 0 or 1."""
    rows = rows.sort_values(["key", "size"], kind="stable")
    p, size, luck = rows["p"].tolist(), rows["size"].tolist(), rows["luck"].tolist()
    held = None  # the row that still has a fraction
    for i in range(len(p)):
        if held is None:
            held = i
            continue
        a, b = held, i
        mass_a, mass_b = p[a] * size[a], p[b] * size[b]
        to_a = min(size[a] - mass_a, mass_b)
        to_b = min(mass_a, size[b] - mass_b)
        if luck[b] * (to_a + to_b) < to_b:
            # With the chance of `to_b`, the amount `to_a` moves: fair on average.
            if size[a] - mass_a <= mass_b:
                p[a], p[b], held = 1.0, (mass_b - to_a) / size[b], b
            else:
                p[a], p[b], held = (mass_a + to_a) / size[a], 0.0, a
        elif mass_a <= size[b] - mass_b:
            p[a], p[b], held = 0.0, (mass_b + to_b) / size[b], b
        else:
            p[a], p[b], held = (mass_a - to_b) / size[a], 1.0, a
        if p[held] <= 0.0 or p[held] >= 1.0:
            p[held] = float(p[held] >= 1.0)
            held = None
    return pd.DataFrame({"row_id": rows["row_id"].to_numpy(), "p": p})


def round_together(
    rows: DataFrame, bucket_rows: int = BUCKET_ROWS, fan_in: int = FAN_IN
) -> DataFrame:
    """`row_id` and `extra` (0 or 1) for rows of (row_id, source, size, p, key, luck).

    `p` must lie between 0 and 1, `size` above 0. Sources are rounded apart,
    each in buckets of about `bucket_rows`; the tree joins `fan_in` of them.
    """
    counts = rows.groupBy("source").agg(F.ceil(F.count("*") / bucket_rows).alias("buckets"))
    same = rows["source"].eqNullSafe(counts["source"])
    left = materialize(
        rows.join(counts, same).select(
            rows["*"], F.pmod(F.xxhash64("key"), F.col("buckets")).alias("bucket")
        ),
        "fractions",
    )
    widest = left.agg(F.max("bucket")).first()[0]
    settled = None
    while widest is not None:
        rounded = left.groupBy("source", "bucket").applyInPandas(_pivot, _ROUNDED)
        after = materialize(left.drop("p").join(rounded, "row_id"), "rounded")
        whole = after.where("p = 0 OR p = 1")
        rest = after.where("p > 0 AND p < 1")
        last = widest == 0
        if last:
            # One document of a source at most: its own chance decides.
            whole = whole.unionByName(rest.withColumn("p", F.when(F.col("luck2") < F.col("p"), 1.0).otherwise(0.0)))
        settled = whole if settled is None else settled.unionByName(whole)
        if last:
            break
        left = rest.withColumn("bucket", F.floor(F.col("bucket") / fan_in))
        widest = int(widest // fan_in)
    if settled is None:
        return left.select("row_id", F.lit(0).cast("long").alias("extra"))
    return settled.select("row_id", F.col("p").cast("long").alias("extra"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.0,
    max_repeat: float = 3.0,
    seed: int = 42,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Copies of each row in the mix.

    Returns `row_id`, `doc_id`, `text_md5`, `source`, `size`, `source_size`,
    `target`, `copies`, `taken` (size times copies).
    """
    doc_id, text = column(id_col), column(text_col).cast("string")
    chance = lambda n: (F.xxhash64(F.lit(seed + n), doc_id, text).bitwiseAND((1 << 53) - 1) / float(1 << 53))
    slim = numbered(
        docs.select(
            doc_id.alias("doc_id"),
            F.md5(F.coalesce(text, F.lit(""))).alias("text_md5"),
            column(source_col).alias("source"),
            n_words(text).alias("size"),
            F.xxhash64(F.lit(seed), doc_id, text).alias("key"),
            chance(1).alias("luck"),
            chance(2).alias("luck2"),
        ),
        "sizes",
    )
    sources = materialize(
        source_targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_repeat),
        "targets",
    )
    same = slim["source"].eqNullSafe(sources["source"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    due = slim.join(sources, same).select(
        slim["*"], "source_size", "target", rate.alias("rate"), F.floor(rate).alias("sure")
    )
    open_ = due.withColumn("p", F.col("rate") - F.col("sure")).where("p > 0 AND size > 0")
    extra = round_together(
        open_.select("row_id", "source", "size", "p", "key", "luck", "luck2"), bucket_rows
    )
    copies = F.col("sure") + F.coalesce("extra", F.lit(0))
    return due.join(extra, "row_id", "left").select(
        "row_id", "doc_id", "text_md5", "source", "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The mix itself: the rows of `docs`, all columns, each as often as taken.

    Documents without words are in no mix. Of rows with the same id and text
    one stands for all, as nothing tells them apart, with all their copies.
    """
    mixed = mix(docs, id_col, text_col, **options)
    own_id, md5, copies, rows = (unused(c, docs.columns) for c in ("_id", "_md5", "_copies", "_rows"))
    due = (
        mixed.where("size > 0")
        .groupBy(F.col("doc_id").alias(own_id), F.col("text_md5").alias(md5))
        .agg(F.sum("copies").alias(copies), F.count("*").alias(rows))
        .where(F.col(copies) > 0)
    )
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    same = column(id_col).eqNullSafe(F.col(own_id)) & (F.md5(text) == F.col(md5))
    joined = docs.join(due, same)
    out = joined.where(F.col(rows) == 1).unionByName(
        joined.where(F.col(rows) > 1).dropDuplicates([id_col, text_col])
    )
    copy = unused("_copy", docs.columns)
    repeat = F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))
    return out.select(*(column(c) for c in docs.columns), repeat.alias(copy)).drop(copy)

