"""Balanced label propagation: linked documents move to their neighbours' shards.

Documents are linked through groups: all rows with equal texts are one, and
callers may add pairs of ids. Every linked row starts in a shard taken from its
hash. In each round, joins give every group the count of its members by shard;
a row wants to go where most of its group is (a group larger than a shard keeps
as many shards as it needs). Moves are bounded by quotas: what two shards swap
is always granted, beyond that only the free room of the receiving shard. Rows
are picked by hash, so no task orders a shard.

At the end, counts are made exact: shards differ by one row at most. Rows
without a link fill the gaps; linked rows above a shard's quota go there too.

Null text counts as empty and has size 16 like an empty one; both belong to the
group of empty texts. Repeated rows are members of one group. Null ids are like
others. An empty table gives an empty result. Results depend on ids and texts
only, not on partitions; identical rows may swap places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.rows import column, numbered, text_bytes
from daybook.workspace import materialize

ROW_OVERHEAD = 16
RANK_BUCKET = 20_000
_U = float(1 << 53)


def _chance(*of) -> Column:
    return F.xxhash64(*of).bitwiseAND((1 << 53) - 1) / _U


def _picked(values: list[int], at: Column) -> Column:
    """The entry `at` (from 0) of a short list of numbers."""
    return F.element_at(F.array(*(F.lit(int(v)).cast("long") for v in values)), (at + 1).cast("int"))


def ranked(rows: DataFrame, within: str | None, bucket_rows: int = RANK_BUCKET) -> DataFrame:
    """`rows` with `rank` from 0, gapless, inside each value of `within`.

    `rows` needs `row_id` and `order`, a hash. Buckets of the hash are ordered
    one by one; sums over the bucket counts put them one behind the other.
    """
    keys = [within] if within else []
    n = rows.count()
    buckets = max(1, -(-n // bucket_rows))
    rows = rows.withColumn("_b", F.pmod(F.xxhash64("order"), F.lit(buckets)))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*keys, "_b").agg(F.count("*").alias("_n"))
        .select(*keys, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = F.row_number().over(Window.partitionBy(*keys, "_b").orderBy("order", "row_id")) - 1
    return (
        rows.withColumn("_in", inside)
        .join(offsets, [*keys, "_b"])
        .withColumn("rank", F.col("_before") + F.col("_in"))
        .drop("_b", "_in", "_before")
    )


def _wishes(placed: DataFrame, members: DataFrame, quota: int, shards: int) -> DataFrame:
    """`row_id`, `order`, `shard`, `to`: where each linked row wants to be."""
    votes = placed.join(members, "row_id").groupBy("group", "shard").agg(F.count("*").alias("n"))
    # At most one entry per shard in a group.
    by_votes = Window.partitionBy("group").orderBy(F.desc("n"), F.xxhash64("group", "shard"))
    whole = Window.partitionBy("group")
    best = (
        votes.withColumn("place", F.row_number().over(by_votes))
        .withColumn("room", F.ceil(F.sum("n").over(whole) / F.lit(max(1, quota))))
        .where(F.col("place") <= F.least("room", F.lit(shards)))
        .groupBy("group")
        .agg(F.array_sort(F.collect_list(F.struct("place", "shard", "n"))).alias("best"))
    )
    joined = placed.join(members, "row_id").join(best, "group")
    homes = F.transform("best", lambda b: b["shard"])
    pick = F.element_at("best", (F.pmod(F.xxhash64("order", "group"), F.size("best")) + 1).cast("int"))
    stays = F.array_contains(homes, F.col("shard"))
    # A row of several groups follows the one with most members at its goal.
    wish = F.struct(
        F.when(stays, F.lit(1 << 60)).otherwise(pick["n"]).alias("pull"),
        F.xxhash64("group").alias("tie"),
        F.when(stays, F.col("shard")).otherwise(pick["shard"]).alias("to"),
    )
    return (
        joined.groupBy("row_id", "order", "shard").agg(F.max(wish).alias("w"))
        .select("row_id", "order", "shard", F.col("w.to").alias("to"))
    )


def propagate(linked: DataFrame, members: DataFrame, shards: int, quota: int, rounds: int) -> DataFrame:
    """`row_id`, `order`, `shard` of the linked rows after some rounds.

    `linked` has `row_id` and `order`, `members` `row_id` and `group`. The driver
    gets one number for each pair of shards.
    """
    spark = linked.sparkSession
    placed = materialize(
        linked.withColumn("shard", F.pmod(F.xxhash64(F.lit("start"), "order"), F.lit(shards)).cast("int")), "placed"
    )
    for n in range(rounds):
        wishes = materialize(_wishes(placed, members, quota, shards), "wishes")
        flow = {(r["shard"], r["to"]): r["count"] for r in wishes.groupBy("shard", "to").count().collect()}
        moves = {k: c for k, c in flow.items() if k[0] != k[1]}
        if not moves:
            return placed
        load, inflow = [0] * shards, [0] * shards
        for (a, b), c in flow.items():
            load[a] += c
            if a != b:
                inflow[b] += c
        granted = []
        for (a, b), c in moves.items():
            free = max(0, quota - load[b]) * c / inflow[b]
            granted.append((a, b, min(1.0, (min(c, moves.get((b, a), 0)) + free) / c)))
        quotas = spark.createDataFrame(granted, "shard int, to int, granted double")
        goes = _chance("order", F.lit(n)) < F.coalesce("granted", F.lit(0.0))
        placed = materialize(
            # One row for each pair of shards.
            wishes.join(F.broadcast(quotas), ["shard", "to"], "left").select(
                "row_id", "order", F.when(goes, F.col("to")).otherwise(F.col("shard")).alias("shard")
            ),
            "placed",
        )
    return placed


def shard(
    docs: DataFrame,
    shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    links: DataFrame | None = None,
    rounds: int = 4,
) -> DataFrame:
    """A shard and a slot in it for every row.

    Returns `doc_id`, `size`, `text_crc32`, `text_md5`, `shard`, `slot` and the
    columns `keep`, which must not be named like these. `links` are pairs of
    ids, its first two columns.
    """
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    slim = numbered(
        docs.select(
            column(id_col).alias("doc_id"),
            (text_bytes(text) + ROW_OVERHEAD).alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.md5(text).alias("text_md5"),
            F.xxhash64(column(id_col), text).alias("order"),
            # In one column, so that no name clashes with those made here.
            *([F.struct(*(column(c) for c in keep)).alias("kept")] if keep else []),
        ),
        "slim",
    )
    total = slim.count()
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    repeated = slim.groupBy("text_md5").agg(F.count("*").alias("n")).where("n > 1").select("text_md5")
    members = slim.join(repeated, "text_md5").select("row_id", F.col("text_md5").alias("group"))
    if links is not None:
        pairs = links.toDF("a", "b", *links.columns[2:]).select("a", "b").where("a <> b").distinct()
        ends = pairs.select(
            F.concat_ws(":", "a", "b").alias("group"), F.explode(F.array("a", "b")).alias("doc_id")
        )
        members = members.unionByName(slim.join(ends, "doc_id").select("row_id", "group"))
    members = materialize(members, "members")
    linked = slim.select("row_id", "order").join(members, "row_id", "left_semi")
    placed = propagate(linked, members, shards, total // shards, rounds)

    inside = materialize(ranked(placed.select("row_id", "order", "shard"), "shard"), "ranked")
    fits = F.col("rank") < _picked(quotas, F.col("shard"))
    held = [0] * shards
    for r in inside.where(fits).groupBy("shard").count().collect():
        held[r["shard"]] = r["count"]
    settled = inside.where(fits).select("row_id", "shard", F.col("rank").alias("slot"))
    loose = inside.where(~fits).select("row_id", "order").unionByName(
        slim.select("row_id", "order").join(members, "row_id", "left_anti")
    )
    # Gap number g of all shards' gaps in a row lies in shard s at slot
    # held[s] + g - (gaps before s).
    starts, gaps = [], 0
    for s in range(shards):
        starts.append(gaps)
        gaps += quotas[s] - held[s]
    ends = [starts[s] + quotas[s] - held[s] for s in range(shards)]
    at = F.size(F.filter(F.array(*(F.lit(e).cast("long") for e in ends)), lambda e: e <= F.col("rank")))
    filled = ranked(loose, None).withColumn("shard", at).select(
        "row_id",
        "shard",
        (_picked(held, F.col("shard")) + F.col("rank") - _picked(starts, F.col("shard"))).alias("slot"),
    )
    return (
        slim.join(settled.unionByName(filled), "row_id")
        .select("doc_id", "size", "text_crc32", "text_md5", F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), *(F.col("kept")[c].alias(c) for c in keep))
    )


def cut_share(assigned: DataFrame) -> DataFrame:
    """Of the rows with equal texts, how many lie apart from most of their group."""
    votes = assigned.groupBy("text_md5", "shard").agg(F.count("*").alias("n"))
    per_group = votes.groupBy("text_md5").agg(F.sum("n").alias("n"), F.max("n").alias("together")).where("n > 1")
    return per_group.agg(F.sum("n").alias("linked"), F.sum(F.col("n") - F.col("together")).alias("apart"))
