"""Benchmark passages in training texts, by word windows.

Words are runs of letters, digits and non-ASCII characters, A-Z in lower case.
A window is `n` consecutive words of a benchmark item; an item with fewer words
is one window of its own length. A document word is hit when it lies inside an
occurrence of a window.

Method: a hash set of word runs of the benchmark, sent along with the scan,
picks the documents that can hold a window; all windows of those are then
compared in full with the windows of the benchmark, as words, not as hashes.
The scan looks at one run in every few words only: each window holds such a run
wherever it starts, so none is missed. A benchmark whose set is above the given
bound is joined by a shuffle instead, with the same result.

Null and empty texts have no words and are clean; items without words are
ignored; a null item id is no item of its own. Repeated rows give one result
row each. Empty tables give clean rows or an empty result. Only built-in
functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.rows import ascii_lower, column, id_and_text, numbered, unused
from daybook.workspace import materialize

SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WINDOW = 10


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def _step(m: int) -> tuple[int, int]:
    """For windows of `m` words: length of the runs looked at, and their distance.

    Runs of `m - d + 1` words, one every `d` words: any `m` words in a row
    hold one of them.
    """
    d = max(1, m // 2)
    return m - d + 1, d


def _runs(words: Column, length: int, distance: int = 1) -> Column:
    """Hashes of runs of `length` words, one every `distance` words."""
    n = F.size(words)
    starts = F.sequence(F.lit(1), n - (length - 1), F.lit(distance))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, length)))
    return F.when(n >= length, hashes).otherwise(F.array().cast("array<bigint>"))


def benchmark_windows(
    benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = WINDOW
) -> DataFrame:
    """Distinct windows: `window` (words joined by blanks), `m` words, `items`."""
    items = id_and_text(benchmark, id_col, text_col).select(
        F.col("doc_id").cast("string").alias("item"), words_of(F.col("text")).alias("words")
    )
    size = F.least(F.size("words"), F.lit(n))
    places = F.sequence(F.lit(1), F.size("words") - size + 1)
    return (
        items.where(F.size("words") > 0)
        .select("item", size.alias("m"), "words", F.explode(places).alias("at"))
        .select("item", "m", F.array_join(F.expr("slice(words, at, m)"), " ").alias("window"))
        .groupBy("window", "m")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    n: int = WINDOW,
    max_runs: int = 50_000,
    max_window_bytes: int = 64 << 20,
) -> DataFrame:
    """One row per document: what of the benchmark it holds.

    Returns `doc_id`, `text_md5`, `n_words`, `hit_words` (sorted places from
    0), `items` (sorted as strings). `max_runs` bounds the hash set sent with
    the scan, `max_window_bytes` the windows sent to every executor; beyond
    them the same work is done by shuffles.
    """
    windows = materialize(benchmark_windows(benchmark, item_col, item_text_col, n), "windows")
    # At most `n` sizes, and one figure each.
    sizes = windows.groupBy("m").agg(F.sum(F.octet_length("window")).alias("b")).collect()
    rows = id_and_text(docs, id_col, text_col).select(
        "doc_id", F.md5("text").alias("text_md5"), words_of(F.col("text")).alias("words")
    )
    plain = rows.withColumn("n_words", F.size("words").cast("long"))
    runs = None
    for m in sorted(r.m for r in sizes):
        length, _ = _step(m)
        found = windows.where(F.col("m") == m).select(
            F.lit(m).alias("m"), F.explode(_runs(F.split("window", " "), length)).alias("run")
        )
        runs = found if runs is None else runs.unionByName(found)
    known = []
    if runs is not None:
        runs = materialize(runs.distinct(), "window-runs")
        known = runs.limit(max_runs + 1).collect()

    if len(known) <= max_runs:
        hit = F.lit(False)
        for m in sorted(r.m for r in sizes):
            length, distance = _step(m)
            wanted = [r.run for r in known if r.m == m]
            starts = F.sequence(F.lit(1), F.size("words") - (length - 1), F.lit(distance))
            some = F.exists(starts, lambda i: F.xxhash64(F.slice("words", i, length)).isin(wanted))  # noqa: B023
            hit = hit | ((F.size("words") >= m) & some)
        marked = numbered(
            plain.withColumn("words", F.when(hit, F.col("words"))), "scanned"
        )
    else:
        stored = numbered(plain, "scanned")
        every = None
        for m in sorted(r.m for r in sizes):
            length, distance = _step(m)
            found = stored.select(
                "row_id", F.lit(m).alias("m"), F.explode(_runs(F.col("words"), length, distance)).alias("run")
            )
            every = found if every is None else every.unionByName(found)
        chosen = every.join(runs, ["m", "run"], "left_semi").select("row_id").distinct()
        chosen = chosen.withColumn("chosen", F.lit(True))
        marked = stored.join(chosen, "row_id", "left").withColumn("words", F.when(F.col("chosen"), F.col("words"))).drop("chosen")

    candidates = marked.where(F.col("words").isNotNull()).select("row_id", "words")
    # Beyond the bound no side goes to every task, however small its files are.
    held = F.broadcast(windows) if sum(r.b for r in sizes) <= max_window_bytes else windows.hint("merge")
    hits = None
    for m in sorted(r.m for r in sizes):
        every_window = F.transform(
            F.sequence(F.lit(1), F.size("words") - (m - 1)),
            lambda i: F.array_join(F.slice("words", i, m), " "),  # noqa: B023
        )
        found = (
            candidates.where(F.size("words") >= m)
            .select("row_id", F.posexplode(every_window).alias("at", "window"))
            .join(held.where(F.col("m") == m), "window")
            .select("row_id", "at", "m", "items")
        )
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        none = F.array().cast("array<string>")
        return marked.select("doc_id", "text_md5", "n_words", F.array().cast("array<int>").alias("hit_words"), none.alias("items"))
    hits = materialize(hits, "window-hits")
    places = (
        hits.select("row_id", F.explode(F.expr("sequence(at, at + m - 1)")).alias("place"))
        .distinct()
        .groupBy("row_id")
        .agg(F.array_sort(F.collect_list("place")).alias("hit_words"))
    )
    items = (
        hits.select("row_id", F.explode("items").alias("item"))
        .distinct()
        .groupBy("row_id")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    # Rows without a hit take no part in the join.
    found = marked.join(places, "row_id", "left").join(items, "row_id", "left")
    return found.select(
        "doc_id",
        "text_md5",
        "n_words",
        F.coalesce("hit_words", F.array().cast("array<int>")).alias("hit_words"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The rows of `docs`, all columns, that hold no benchmark window."""
    found = find_contamination(docs, benchmark, id_col, text_col, **options)
    bad_id, bad_md5 = (unused(c, docs.columns) for c in ("_bad_id", "_bad_md5"))
    bad = found.where(F.size("hit_words") > 0).select(
        F.col("doc_id").alias(bad_id), F.col("text_md5").alias(bad_md5)
    ).distinct()
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    same = column(id_col).eqNullSafe(F.col(bad_id)) & (F.md5(text) == F.col(bad_md5))
    return docs.join(bad, same, "left_anti")


def without_words(text: Column, places: Column) -> Column:
    """The text without the words at the given places, counted from 0.

    A removed word takes the separators before it along.
    """
    word = "[0-9A-Za-z\\x{80}-\\x{10FFFF}]"
    pieces = F.regexp_extract_all(text, F.lit(f"[^0-9A-Za-z\\x{{80}}-\\x{{10FFFF}}]*{word}+"), F.lit(0))
    tail = F.regexp_extract(text, "[^0-9A-Za-z\\x{80}-\\x{10FFFF}]*$", 0)
    left = F.filter(pieces, lambda piece, i: ~F.array_contains(places, i))
    return F.concat(F.array_join(left, ""), tail)
