"""Near-duplicates by SimHash fingerprints and deletion-variant signatures.

A fingerprint has 64 bits; a bit is set when it is set in over half the hashes
of a text's word shingles. Two fingerprints link when at most `max_bits` bits
differ.

Candidates: the bits are cut into `max_bits // 2 + 1` segments, so that one
segment differs by at most one bit. Each segment is indexed as it is and with
each of its bits deleted in turn; fingerprints that meet under a key are
compared in full. Where many fingerprints share a key, they are not paired: the
rest of their bits is indexed with as many deletions as may still differ, and
under such a key lie at most `2 ** max_bits` fingerprints, all of them links.

Equal fingerprints count once, so copies make no pairs. Null and empty texts
have fingerprint zero and link like any other; a text with fewer words than a
shingle is one shingle. Null ids take part, and a component of null ids only
has a null id. Repeated rows give one result row each. Texts are read whole.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.components import components
from daybook.llm.rows import column, id_and_text, map_text, numbered, unused
from daybook.workspace import materialize

HASH_SEED = 42
BITS = 64
# Fingerprints under one key from which they are no longer paired.
PAIRED_UP_TO = 64
# Shingles hashed at a time, for texts of any length.
_AT_ONCE = 100_000


def fingerprint(text: str, shingle: int = 3) -> int:
    """The fingerprint as an unsigned number; bit 0 is the lowest."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for at in range(0, n, _AT_ONCE):
        to = min(n, at + _AT_ONCE)
        runs = zip(*(words[at + k : to + k] for k in range(shingle))) if len(words) >= shingle else [words]
        hashes = np.fromiter((digest(join(r), HASH_SEED) for r in runs), dtype=np.uint64, count=to - at)
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), shingle: int = 3) -> DataFrame:
    """`keep` and `fp` (as a signed long) for each row; `docs` has `text`."""

    def make():
        def work(texts: list[str]) -> list[pa.Array]:
            values = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
            return [pa.array(values.view(np.int64))]

        return work

    return map_text(docs, make, [T.StructField("fp", T.LongType())], keep=keep)


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment."""
    k = max_bits // 2 + 1
    cuts = [BITS * n // k for n in range(k + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _mask(low: int, width: int) -> int:
    """The bits of a segment, as a signed long."""
    m = ((1 << width) - 1) << low
    return m - (1 << 64) if m >= 1 << 63 else m


def _bit(n: int) -> int:
    return (1 << n) if n < 63 else -(1 << 63)


def index(fps: DataFrame, max_bits: int) -> DataFrame:
    """(kind, key, side, fp): the variants each fingerprint is found under.

    `kind` tells segment and deleted bit (none: the lowest kind of a segment);
    `side` is the deleted bit, as only pairs that differ there are new.
    """
    segments = _segments(max_bits)
    variants = []
    for s, (low, width) in enumerate(segments):
        part = F.col("fp").bitwiseAND(F.lit(_mask(low, width)).cast("long"))
        kind = s * (BITS + 1)
        variants.append(F.struct(F.lit(kind).alias("kind"), part.alias("key"), F.lit(0).cast("long").alias("side")))
        # If all other segments differ by two bits or more, an even bound
        # leaves none for the last.
        if s == len(segments) - 1 and max_bits % 2 == 0:
            continue
        for b in range(low, low + width):
            one = F.lit(_bit(b)).cast("long")
            variants.append(
                F.struct(
                    F.lit(kind + 1 + b).alias("kind"),
                    part.bitwiseAND(F.bitwise_not(one)).alias("key"),
                    F.col("fp").bitwiseAND(one).alias("side"),
                )
            )
    return fps.select("fp", F.explode(F.array(*variants)).alias("v")).select("v.*", "fp")


def _refined(crowded: DataFrame, max_bits: int) -> DataFrame:
    """Links among fingerprints under crowded keys, by further deletions."""
    found = None
    for s, (low, width) in enumerate(_segments(max_bits)):
        rest = [b for b in range(BITS) if not low <= b < low + width]
        kind = s * (BITS + 1)
        for deleted, chosen in (
            (max_bits, F.col("kind") == kind),
            (max_bits - 1, (F.col("kind") > kind) & (F.col("kind") <= kind + BITS)),
        ):
            masks = []
            for bits in combinations(rest, min(max(deleted, 0), len(rest))):
                m = (1 << BITS) - 1 - sum(1 << b for b in bits)
                masks.append(m - (1 << 64) if m >= 1 << 63 else m)
            # The masks as text: one literal rather than one for each.
            listed = F.split(F.lit(",".join(map(str, masks))), ",").cast("array<bigint>")
            variants = crowded.where(chosen).select(
                "kind", "key", "side", "fp", F.posexplode(listed).alias("which", "mask")
            )
            stars = variants.groupBy(
                "kind", "key", "which", F.col("fp").bitwiseAND(F.col("mask")).bitwiseAND(_kept_bits(s, max_bits)).alias("left")
            ).agg(F.collect_set("fp").alias("near"))
            pairs = stars.where(F.size("near") > 1).select(
                F.array_min("near").alias("a"), F.explode("near").alias("b")
            ).where("a <> b")
            found = pairs if found is None else found.unionByName(pairs)
    return found.distinct()


def _kept_bits(segment: int, max_bits: int) -> Column:
    """All bits outside a segment; its own are told by the key."""
    low, width = _segments(max_bits)[segment]
    return F.lit(~_mask(low, width)).cast("long")


def links(fps: DataFrame, max_bits: int = 2, paired_up_to: int = PAIRED_UP_TO) -> DataFrame:
    """Pairs `a`, `b` of distinct fingerprints; all links follow from them.

    Under crowded keys a star stands for the links of a key's members.
    """
    entries = index(fps, max_bits)
    exact = F.col("kind") % (BITS + 1) == 0
    counts = (
        entries.groupBy("kind", "key")
        .agg(F.count("*").alias("n"), F.min("side").alias("s0"), F.max("side").alias("s1"))
        .where((F.col("n") > 1) & (exact | (F.col("s0") != F.col("s1"))))
        .select("kind", "key", "n")
    )
    # Both sides are shuffled: Spark sizes them by the fingerprints' files, which
    # know nothing of the variants, and would send all entries to every task.
    met = materialize(entries.hint("merge").join(counts, ["kind", "key"]), "variants")
    few = met.where(F.col("n") <= paired_up_to)
    a = few.select("kind", "key", F.col("fp").alias("a"), F.col("side").alias("side_a"))
    b = few.select("kind", "key", F.col("fp").alias("b"), F.col("side").alias("side_b"))
    differ = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    paired = (
        a.join(b, ["kind", "key"])
        .where((F.col("a") < F.col("b")) & (exact | (F.col("side_a") != F.col("side_b"))) & (differ <= max_bits))
        .select("a", "b")
    )
    crowded = met.where(F.col("n") > paired_up_to)
    return paired.unionByName(_refined(crowded, max_bits)).distinct()


def groups(fps: DataFrame, max_bits: int, paired_up_to: int) -> DataFrame:
    """`fp`, `root`, `component_id` from `fps` (fp, doc_id), whose fp are distinct."""
    linked = materialize(components(links(fps.select("fp"), max_bits, paired_up_to)), "roots")
    rooted = fps.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def find_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
    paired_up_to: int = PAIRED_UP_TO,
) -> DataFrame:
    """`row_id`, `doc_id`, `text_md5`, `fp`, `root`, `component_id` for each row.

    `component_id` is the smallest id reachable over links, the row's own
    included; `root` is the component's smallest fingerprint.
    """
    rows = id_and_text(docs, id_col, text_col).withColumn("text_md5", F.md5("text"))
    slim = numbered(fingerprints(rows, ("doc_id", "text_md5"), shingle), "fingerprints")
    distinct = materialize(slim.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "distinct")
    return slim.join(groups(distinct, max_bits, paired_up_to), "fp").select(
        "row_id", "doc_id", "text_md5", "fp", "root", "component_id"
    )


def keep_one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """The rows of `docs`, all columns, one of each group of near-duplicates.

    The row with the smallest id stays (null ids last); of rows with the same
    id the one with the smallest digest of its text, of identical texts one.
    """
    found = materialize(find_near_duplicates(docs, id_col, text_col, shingle, max_bits), "near-duplicates")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_md5")
    kept_id, kept_md5 = (unused(c, docs.columns) for c in ("_kept_id", "_kept_md5"))
    kept = found.groupBy("root").agg(F.min(order).alias("k")).select(
        F.col("k.doc_id").alias(kept_id), F.col("k.text_md5").alias(kept_md5)
    )
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    same = column(id_col).eqNullSafe(F.col(kept_id)) & (F.md5(text) == F.col(kept_md5))
    rows = docs.join(kept, same, "left_semi")
    twice = (
        found.groupBy("doc_id", "text_md5").agg(F.count("*").alias("n")).where("n > 1")
        .select(F.col("doc_id").alias(kept_id), F.col("text_md5").alias(kept_md5))
    )
    once = rows.join(twice, same, "left_anti")
    more = rows.join(twice, same, "left_semi").dropDuplicates([id_col, text_col])
    return once.unionByName(more)
