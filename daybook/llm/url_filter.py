"""Which pages to keep, judged by their addresses alone.

Rules come first: a rule names a host and the start of a path, fits that host
and its subdomains, and the longest fitting rule decides (of equally long ones
that with the longer host). What no rule fits is judged by a tree of path
templates, built for each host from its distinct paths:

1. From the root down, a segment stays as it is when enough of the paths below
   its parent go through it. The rest are variable and become a wildcard of
   their kind: number, date, hex string, mixture, word, with a file ending kept.
2. From the leaves up, sibling branches that continue alike are merged when
   their labelled purity is statistically the same: they lie in the same third
   of the scale and within `z` standard errors of what that third holds
   together. Branches with few labels are not merged, for lack of evidence.
3. A template is rejected when its purity, the share of bad among labelled
   paths, is `reject_at` or more. It is smoothed towards the purity of the
   same template over all hosts, and that towards the purity of everything.

Labels are the verdicts of the rules unless `bad` names a column with others.

Host and path: the first ``://`` ends the scheme; a null address, or one
without it, has an empty host and path, and forms a template of its own. Paths
count once however often they are repeated, so repeated rows change nothing and
each has its row in the result. Null page ids are kept. Segments below `levels`
are one wildcard, ``**``. An empty table gives an empty result. Only built-in
functions are used; nothing is grouped by host alone without partial sums.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.rows import ascii_lower, column
from daybook.workspace import materialize

ALLOW, BLOCK = "allow", "block"
MOST_RULES = 1000
THIRDS = ("*low", "*mid", "*high")


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


class Tree(NamedTuple):
    """What the template tree goes by."""

    levels: int = 6  # segments a template names
    least_paths: int = 3  # paths through a segment that is not variable,
    least_share: float = 0.02  # and their share of those through its parent
    least_labels: int = 5  # labels of a branch that may be merged
    z: float = 1.96
    own_weight: float = 4.0  # labels that the template over all hosts counts as
    all_weight: float = 10.0  # labels that the overall purity counts as
    reject_at: float = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def _rule_of(rules: Sequence[Rule], pick) -> Column:
    """`pick` of the longest rule that fits `host` and `path`; null without one."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules, {MOST_RULES} at most")
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.host) + len(r.path), len(r.host))):
        at_home = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        chosen = F.when(at_home & F.col("path").startswith(rule.path), F.lit(pick(rule))).otherwise(chosen)
    return chosen


def segment_kind(segment: Column) -> Column:
    """The wildcard a variable segment becomes."""
    ending = F.regexp_extract(segment, "[.][A-Za-z][A-Za-z0-9]{0,4}$", 0)
    base = F.regexp_replace(segment, "[.][A-Za-z][A-Za-z0-9]{0,4}$", "")
    kind = (
        F.when(base.rlike("^[0-9]{4}-[0-9]{2}(-[0-9]{2})?$"), "<date>")
        .when(base.rlike("^[0-9]+$"), "<num>")
        .when(base.rlike("^[0-9A-Fa-f-]{8,}$"), "<hex>")
        .when(base.rlike("[0-9]"), "<mixed>")
        .otherwise("<word>")
    )
    return F.concat(kind, ending)


def _segments(levels: int) -> Column:
    found = F.array_remove(F.split("path", "/"), "")
    folded = F.concat(F.slice(found, 1, levels), F.array(F.lit("**")))
    return F.when(F.size(found) > levels, folded).otherwise(found)


def path_templates(paths: DataFrame, tree: Tree) -> DataFrame:
    """`paths` (distinct `host`, `path`, any labels) with `template`."""
    now = materialize(
        paths.withColumn("segments", _segments(tree.levels)).withColumn("template", F.lit("")), "url-paths"
    )
    deepest = now.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(deepest):
        here = now.where(F.size("segments") > level).withColumn("segment", F.col("segments")[level])
        through = here.groupBy("host", "template", "segment").agg(F.count("*").alias("n"))
        below = through.groupBy("host", "template").agg(F.sum("n").alias("all"))
        fixed = (
            through.where(F.col("n") >= tree.least_paths)
            .join(below, ["host", "template"])
            .where((F.col("n") >= tree.least_share * F.col("all")) | (F.col("segment") == "**"))
            .select("host", "template", "segment", F.lit(True).alias("fixed"))
        )
        segment = F.when(F.col("fixed") | (F.col("segment") == "**"), F.col("segment"))
        segment = F.coalesce(segment, segment_kind(F.col("segment")))
        named = here.join(fixed, ["host", "template", "segment"], "left").withColumn(
            "template", F.concat("template", F.lit("/"), segment)
        )
        done = now.where(F.size("segments") <= level)
        now = materialize(done.unionByName(named.select(now.columns)), "url-paths")
    return now.drop("segments")


def _purity(bad: Column | str, labelled: Column | str, prior: Column, weight: float) -> Column:
    bad, labelled = (F.col(c) if isinstance(c, str) else c for c in (bad, labelled))
    return (bad + prior * weight) / (labelled + weight)


def merge_branches(templates: DataFrame, tree: Tree) -> DataFrame:
    """`templates` (`host`, `template`, `labelled`, `bad`) with `branch`, the merged template."""
    now = materialize(templates.withColumn("branch", F.col("template")), "url-branches")
    deepest = now.agg(F.max(F.size(F.split("branch", "/")))).first()[0] or 0
    for at in range(deepest - 1, 0, -1):
        parts = F.split("branch", "/")
        whole = (
            now.groupBy("host", "branch")
            .agg(F.sum("labelled").alias("own"), F.sum("bad").alias("own_bad"))
            .where((F.size(parts) > at) & (F.col("own") >= tree.least_labels))
            .withColumn("before", F.array_join(F.slice(parts, 1, at), "/"))
            .withColumn("after", F.array_join(F.slice(parts, at + 2, tree.levels + 2), "/"))
            .withColumn("depth", F.size(parts))
            .withColumn("third", F.least(F.lit(2), F.floor(F.col("own_bad") * 3 / F.col("own")).cast("int")))
        )
        alike = ["host", "before", "after", "depth", "third"]
        pooled = whole.groupBy(*alike).agg(
            F.sum("own").alias("pool"), F.sum("own_bad").alias("pool_bad"), F.count("*").alias("branches")
        )
        rate = (F.col("pool_bad") + 0.5) / (F.col("pool") + 1.0)
        near = F.abs(F.col("own_bad") / F.col("own") - rate) <= tree.z * F.sqrt(rate * (1.0 - rate) / F.col("own"))
        renamed = (
            whole.join(pooled.where("branches > 1"), alike)
            .where(near)
            .select(
                "host",
                "branch",
                F.concat_ws(
                    "/",
                    "before",
                    F.element_at(F.array(*map(F.lit, THIRDS)), F.col("third") + 1),
                    F.when(F.col("depth") > at + 1, F.col("after")),
                ).alias("merged"),
            )
        )
        now = materialize(
            now.join(renamed, ["host", "branch"], "left")
            .withColumn("branch", F.coalesce("merged", "branch"))
            .drop("merged"),
            "url-branches",
        )
    return now


def judge_templates(paths: DataFrame, tree: Tree) -> DataFrame:
    """`host`, `template`, `branch`, `purity` from paths with `template` and `is_bad` (null: no label)."""
    templates = paths.groupBy("host", "template").agg(
        F.count("is_bad").alias("labelled"), F.count_if(F.col("is_bad")).alias("bad")
    )
    merged = merge_branches(templates, tree)
    totals = merged.agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b")).first()
    overall = (totals.b + 0.5) / (totals.l + 1.0) if totals.l is not None else 0.5
    over_hosts = merged.groupBy("template").agg(F.sum("labelled").alias("every"), F.sum("bad").alias("every_bad"))
    branches = merged.groupBy("host", "branch").agg(F.sum("labelled").alias("own"), F.sum("bad").alias("own_bad"))
    prior = _purity("every_bad", "every", F.lit(overall), tree.all_weight)
    return (
        merged.join(over_hosts, "template")
        .join(branches, ["host", "branch"])
        .select("host", "template", "branch", _purity("own_bad", "own", prior, tree.own_weight).alias("purity"))
    )


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    bad: str | None = None,
    tree: Tree = Tree(),
) -> DataFrame:
    """One row per page: `page_id`, `host`, `path`, `rule`, `verdict`, `template`, `branch`, `purity`.

    `bad` names a boolean column of labels (null: none), taken instead of the
    rules' verdicts; where equal paths have several, one bad label counts.
    """
    rows = pages.select(
        column(id_col).alias("page_id"),
        column(url_col).cast("string").alias("url"),
        (column(bad).cast("boolean") if bad else F.lit(None).cast("boolean")).alias("given"),
    )
    host, path = host_and_path(F.col("url"))
    rows = rows.select("page_id", "given", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", _rule_of(rules, lambda r: r.host + r.path)).withColumn(
        "ruled", _rule_of(rules, lambda r: r.verdict)
    )
    label = F.col("given") if bad else F.col("ruled") == BLOCK
    paths = rows.groupBy("host", "path").agg(F.max(label).alias("is_bad"))
    templated = materialize(path_templates(paths, tree), "url-templates")
    judged = judge_templates(templated, tree)
    known = templated.join(judged, ["host", "template"]).select("host", "path", "template", "branch", "purity")
    found = rows.join(known, ["host", "path"], "left")
    own = F.when(F.col("purity") >= tree.reject_at, BLOCK).otherwise(ALLOW)
    return found.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "template", "branch", "purity"
    )
