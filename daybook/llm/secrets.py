"""Secrets in texts, told apart by how widely the corpus shares them.

A value that many owners carry is a copied example; one that a single owner
carries and that looks random is taken for live. Values leave the scanning task
only as hashes.

Null and empty texts have no spans; a null repository or owner counts as none.
Repeated rows and null ids give one result row each. An empty table gives an
empty result. A text is scanned whole, in time linear in its length.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.rows import id_and_text, map_text, numbered

BASE_KINDS = ("assign", "access", "hex")
ADDED_KINDS = ("private_key", "code_host", "chat", "cloud_api", "web_token")
KINDS = BASE_KINDS + ADDED_KINDS

EXAMPLE, LIVE, UNCLEAR = "example", "live", "unclear"

# Letters of the keywords in either case, ASCII only.
_ASSIGN = re.compile(
    r"""(?ai)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# The leftmost match of 16 or more starts where its run of digits starts.
_HEX = re.compile(r"[0-9a-f]{16,}+")
_ADDED = {
    "private_key": (
        "-----BEGIN ",
        re.compile(r"-----BEGIN (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----[A-Za-z0-9+/=\s]++-----END (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----"),
    ),
    "code_host": ("gh", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}+")),
    "chat": ("xox", re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}+")),
    "cloud_api": ("AIza", re.compile(r"AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])")),
    "web_token": ("eyJ", re.compile(r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+")),
}
_PLACEHOLDER = re.compile(r"(?i)example|sample|dummy|changeme|placeholder|your[_-]?|xxxx|12345678|abcdef")

FOUND = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("base", T.BooleanType()),
        T.StructField("value_hash", T.StringType()),
        T.StructField("random", T.BooleanType()),
    ]
)
_ARROW = pa.struct(
    [
        ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
        ("base", pa.bool_()), ("value_hash", pa.string()), ("random", pa.bool_()),
    ]
)


def entropy(value: str) -> float:
    """Bits per character of a value's own letter frequencies."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def looks_random(value: str) -> bool:
    """Long on entropy, mixed, and no placeholder."""
    mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
    return mixed and entropy(value) >= 3.0 and not _PLACEHOLDER.search(value)


def scan(text: str) -> list[tuple]:
    """(kind, start, end, base, value hash, looks random), by start, then kind.

    The base spans always stay; an added one is kept beside them unless a base
    span already covers it whole.
    """
    base = []
    if "=" in text or ":" in text:
        base += [("assign", *m.span(), m[1]) for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    base += [("access", *m.span(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    base += [("hex", *m.span(), m[0]) for m in _HEX.finditer(text)]
    added = [
        (kind, *m.span(), m[0])
        for kind, (sign, pattern) in _ADDED.items()
        if sign in text
        for m in pattern.finditer(text)
    ]
    if added:
        base.sort(key=lambda s: s[1])
        kept, at, reach = [], 0, -1
        for span in sorted(added, key=lambda s: s[1]):
            while at < len(base) and base[at][1] <= span[1]:
                reach = max(reach, base[at][2])
                at += 1
            if reach < span[2]:
                kept.append(span)
        added = kept
    order = {kind: n for n, kind in enumerate(KINDS)}
    return [
        (k, s, e, k in BASE_KINDS, hashlib.sha256(v.encode("utf-8", "surrogatepass")).hexdigest(), looks_random(v))
        for k, s, e, v in sorted(base + added, key=lambda x: (x[1], order[x[0]]))
    ]


def ownership(found: DataFrame) -> DataFrame:
    """Per candidate: number of distinct repositories and of distinct owners.

    `found` has `value_hash`, `repository`, `owner`. Pairs are made distinct in
    each task before they meet, so a value in every document is no hot group.
    """
    repositories = found.select("value_hash", "repository").distinct().groupBy("value_hash")
    owners = found.select("value_hash", "owner").distinct().groupBy("value_hash")
    return repositories.agg(F.count("repository").alias("repositories")).join(
        owners.agg(F.count("owner").alias("owners")), "value_hash"
    )


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    repository_col: str = "doc_id",
    owner_col: str = "source",
    example_owners: int = 3,
) -> DataFrame:
    """`doc_id` and `secrets`, an array of spans, for each row of `docs`.

    Each span has kind, start, end (code points, end exclusive), base,
    value_hash, repositories, owners and a verdict: `example` where at least
    `example_owners` owners carry the value, `live` where at most one does and
    it looks random, else `unclear`.
    """

    def make():
        def work(texts: list[str]) -> list[pa.Array]:
            names = _ARROW.names
            spans = [[dict(zip(names, s)) for s in scan(t)] for t in texts]
            return [pa.array(spans, type=pa.list_(_ARROW))]

        return work

    rows = id_and_text(docs, id_col, text_col, repository=repository_col, owner=owner_col)
    found = map_text(
        rows, make, [T.StructField("found", T.ArrayType(FOUND))], keep=("doc_id", "repository", "owner")
    )
    found = numbered(found, "secrets")
    spans = found.select("row_id", "repository", "owner", F.explode("found").alias("s")).select(
        "row_id", "repository", "owner", "s.*"
    )
    counted = ownership(spans)
    place = F.array(*(F.lit(k) for k in KINDS))
    judged = (
        spans.join(counted, "value_hash")
        .withColumn(
            "verdict",
            F.when(F.col("owners") >= example_owners, EXAMPLE)
            .when((F.col("owners") <= 1) & F.col("random"), LIVE)
            .otherwise(UNCLEAR),
        )
        .groupBy("row_id")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        "start",
                        F.array_position(place, F.col("kind")).alias("place"),
                        "end", "kind", "base", "value_hash", "repositories", "owners", "verdict",
                    )
                )
            ).alias("secrets")
        )
    )
    tidy = F.transform(
        "secrets",
        lambda s: F.struct(
            *(s[c].alias(c) for c in ("kind", "start", "end", "base", "value_hash", "repositories", "owners", "verdict"))
        ),
    )
    with_spans = (
        found.where(F.size("found") > 0).select("row_id", "doc_id").join(judged.select("row_id", tidy.alias("secrets")), "row_id")
    ).select("doc_id", "secrets")
    without = found.where(F.size("found") == 0).select(
        "doc_id", F.array().cast(with_spans.schema["secrets"].dataType).alias("secrets")
    )
    return with_spans.unionByName(without)
