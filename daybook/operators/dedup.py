"""First row per key, and insert-only loading against stored keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.operators.layout import fixed_first

# Rows of one key that a single task may hold.
HOT_ROWS = 1_000_000
# Keys that are counted at once in search of a hot one.
_COUNTED = 1 << 12


def has_hot_key(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> bool:
    """Whether a key has more than `hot_rows` rows; rows without a key do not count.

    Every task counts its most frequent keys, and only those counts are sent. A
    count is off by one row in three thousand of the table's at most.
    """
    counted = F.expr(f"approx_top_k(`{key}`, 1, {_COUNTED})").alias("top")
    top = df.where(F.col(key).isNotNull()).agg(counted).first()["top"]
    return bool(top) and top[0]["count"] > hot_rows


def dedup_first(df: DataFrame, keys, order, copies: str | None = None, hot: bool = True) -> DataFrame:
    """Keep the first row of every key in the given order.

    `order` must tell any two rows of a key apart. Each task keeps one
    candidate per key before anything is shuffled, so a key that makes up a
    large part of the table does not gather in one task. Where no key is `hot`
    (see `has_hot_key`), rows are sorted after the shuffle only. Rows with a
    NULL in the last key are all kept: they have no key to repeat. `copies`
    names a column for the number of rows behind each kept one.
    """
    keys, order = list(keys), list(order)
    columns = df.columns
    rest = [c for c in columns if c not in keys and c not in order]
    missing = F.col(keys[-1]).isNull()
    own = F.when(missing, F.struct(*order)).alias("_own")
    if not hot:
        of_key = Window.partitionBy(*keys, "_own")
        found = {"_nth": F.row_number().over(of_key.orderBy(*order, *rest))}
        if copies:
            found[copies] = F.count("*").over(of_key)
        dealt = df.select(*fixed_first(df), own).repartition(*keys, "_own")
        kept = dealt.withColumns(found).where(F.col("_nth") == 1)
        return kept.select(*columns, *([copies] if copies else []))
    # Columns of the order stand in the candidate once.
    places = {c: f"o{i}" for i, c in enumerate(order)}
    first = F.struct(
        F.struct(*(F.col(c).alias(at) for c, at in places.items())).alias("at"), *([F.struct(*rest).alias("row")] if rest else [])
    )
    aggregates = [F.min(first).alias("_first")]
    if copies:
        aggregates.append(F.count("*").alias(copies))
    kept = df.groupBy(*keys, own).agg(*aggregates)
    out = [
        F.col(c) if c in keys else F.col(f"_first.at.{places[c]}" if c in places else f"_first.row.`{c}`").alias(c)
        for c in columns
    ]
    return kept.select(*out, *([copies] if copies else []))


def known_keys(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Those keys of the stored table that the new rows carry.

    The small result, not the stored table, decides about each new row. A
    small batch is broadcast against the stored keys, which then stay where
    they are; a table bucketed by the key is not shuffled for a large batch
    either. Only the key column is read.
    """
    return existing.select(key).join(new.select(key), key, "left_semi")


def append_ignore(new: DataFrame, existing: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Split new rows into those to append and those whose key is stored.

    An existing key wins, whatever the new row holds. Pass rows with one row
    per key, see `dedup_first`. Evaluate both parts before appending to the
    table that `existing` reads.
    """
    known = known_keys(new, existing, key)
    return new.join(known, key, "left_anti"), new.join(known, key, "left_semi")


def upsert_latest(new: DataFrame, existing: DataFrame, key: str, version: str) -> DataFrame:
    """The table after new rows replaced older ones of their key.

    The row with the highest `version` stays, a NULL version below all others; a
    stored row wins a tie, and among new rows the higher values in column order
    do. Each task keeps one candidate per key before the shuffle, so a key with
    very many versions does not gather in one task. Rows without a key are left
    out.
    """
    columns = existing.columns
    rest = [c for c in columns if c not in (key, version)]
    tagged = existing.withColumn("_stored", F.lit(1)).unionByName(
        new.select(*columns).withColumn("_stored", F.lit(0))
    )
    newest = F.max(F.struct(version, "_stored", *rest)).alias("_newest")
    kept = tagged.where(F.col(key).isNotNull()).groupBy(key).agg(newest)
    return kept.select(key, "_newest.*").select(*columns)
