import pytest

from daybook.llm.queries import ORACLES, URL_RULES, op12_url_filter
from daybook.llm.url_filter import Rule, Tree, filter_urls
from workload.compare import connect, differences


def pages_of(spark, *urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


def by_id(df):
    return {r.page_id: r for r in df.collect()}


def test_same_as_sql(spark, sf_dir):
    assert differences(op12_url_filter(spark, sf_dir), connect(sf_dir), ORACLES["op12_url_filter"]) == ""


def test_sql_on_awkward_addresses(spark, tmp_path):
    rows = [f"http://h{n % 3}.example.net/{'es' if n % 4 else 'x'}/{n % 7}/a{n}.html?q" for n in range(300)]
    rows += [f"https://deep.example.org/{'/'.join('abcdefghij'[: n % 10])}/" for n in range(60)]
    rows += [f"http://d.example.com/2024-0{n % 9}/deadbeef{n:04x}/v{n}" for n in range(90)]
    rows += [None, "", "no scheme", "://", "x://?q", "a://b://c/d", "HTTP://EXAMPLE.COM/en/1", "h://ex.com\nmore/p"] * 3
    docs = spark.createDataFrame([(n // 2, u, "x") for n, u in enumerate(rows)], "page_id long, url string, html string")
    docs.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    duck = connect("/root/testdata/sf0.001")
    duck.execute(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert differences(op12_url_filter(spark, str(tmp_path)), duck, ORACLES["op12_url_filter"]) == ""


def test_host_path_and_longest_rule(spark):
    cases = [
        ("http://A.Example.COM/en/1?x#y", "a.example.com", "/en/1", "example.com/en/", "block"),
        ("http://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("http://x.www.example.com/en/1", "x.www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("http://example.com/EN/1", "example.com", "/EN/1", "com/", "allow"),
        ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        ("http://net/es/", "net", "/es/", "net/es/", "block"),
        ("http://example.com?x", "example.com", "", None, None),
        ("http://example.com:80/en/", "example.com:80", "/en/", None, None),
        ("a://b://c", "b:", "//c", None, None),
        (None, "", "", None, None),
        ("www.example.com/en/1", "", "", None, None),
    ]
    out = by_id(filter_urls(pages_of(spark, *(c[0] for c in cases)), URL_RULES))
    for n, (_, host, path, rule, verdict) in enumerate(cases):
        assert (out[n].host, out[n].path, out[n].rule) == (host, path, rule)
        assert out[n].verdict in ("allow", "block") if verdict is None else out[n].verdict == verdict


def test_variable_segments_become_wildcards_and_pure_templates_go(spark):
    urls, bad = [], []
    for n in range(40):
        urls += [f"http://h/shop/item{n}/view", f"http://h/spam/{n}.html", f"http://h/u/{n:08x}-ab/2024-01-{n % 28:02d}"]
        bad += [n % 10 == 0, True if n < 30 else None, False]
    rows = [(n, u, b) for n, (u, b) in enumerate(zip(urls, bad))]
    pages = spark.createDataFrame(rows, "page_id long, url string, spam boolean")
    out = by_id(filter_urls(pages, (), bad="spam", tree=Tree(least_paths=10, least_share=0.1)))
    assert {r.template for r in out.values()} == {"/shop/<mixed>/view", "/spam/<num>.html", "/u/<hex>/<date>"}
    assert {r.verdict for r in out.values() if r.template.startswith("/spam")} == {"block"}
    assert {r.verdict for r in out.values() if not r.template.startswith("/spam")} == {"allow"}


def test_alike_branches_are_merged_and_share_their_labels(spark):
    rows = []
    for lang, share in (("en", 0), ("de", 0), ("fr", 1), ("es", 1), ("it", None)):
        rows += [(len(rows), f"http://h/{lang}/{n}", None if share is None else bool(share)) for n in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, spam boolean")
    out = filter_urls(pages, (), bad="spam").select("template", "branch", "verdict").distinct().collect()
    assert {r.template: (r.branch, r.verdict) for r in out} == {
        "/en/<num>": ("/*low/<num>", "allow"),
        "/de/<num>": ("/*low/<num>", "allow"),
        "/fr/<num>": ("/*high/<num>", "block"),
        "/es/<num>": ("/*high/<num>", "block"),
        "/it/<num>": ("/it/<num>", "block"),
    }


def test_nulls_repeats_long_addresses_and_clashing_names(spark):
    names = "host path rule verdict template branch purity given ruled segments segment n all fixed is_bad"
    rows = [(None, None), (1, "http://h/" + "a/" * 50_000), (1, "http://h/" + "a/" * 50_000), (2, "")]
    pages = spark.createDataFrame([(*r, *"x" * len(names.split())) for r in rows],
                                  "page_id long, url string, " + ", ".join(f"`{c}` string" for c in names.split()))
    out = filter_urls(pages, URL_RULES).collect()
    assert sorted((r.page_id is None, r.host) for r in out) == [(False, ""), (False, "h"), (False, "h"), (True, "")]
    assert {r.template for r in out if r.host == "h"} == {"/" + "<word>/" * 6 + "**"}
    empty = filter_urls(pages.limit(0), URL_RULES)
    assert empty.count() == 0 and empty.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]


def test_too_many_rules_are_refused(spark):
    with pytest.raises(ValueError, match="1001 rules"):
        filter_urls(pages_of(spark, "http://a/b"), [Rule("allow", f"h{n}", "/") for n in range(1001)])
