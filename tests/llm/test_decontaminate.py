import re

import pytest
from pyspark.sql import functions as F

from daybook.llm.decontaminate import drop_contaminated, find_contamination, without_words

LONG = " ".join(f"w{n}" for n in range(30))
ITEMS = [(1, LONG), (20, "Alpha, beta gamma!"), (3, "solo"), (4, "..."), (5, None), (None, "no item id here"), (1, LONG), (7, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 tail")]
DOCS = [
    (1, LONG), (2, "x " + " ".join(f"W{n}" for n in range(4, 14)) + ", y"), (3, " ".join(f"w{n}" for n in range(4, 13))),
    (4, "alpha-BETA gamma. Alpha beta"), (5, "solo solo, not soloist"), (6, None), (7, ""), (8, "..."), (9, "é w1 w2"),
    (None, "alpha beta gamma"), (4, "alpha-BETA gamma. Alpha beta"), (11, "clean text " * 400), (12, ("z " * 997) + LONG),
]


def words(t):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def expected():
    out = []
    items = [(str(i), words(t)) for i, t in ITEMS]
    for doc_id, text in DOCS:
        w, hit, found = words(text), set(), set()
        for item, b in items:
            m = min(10, len(b))
            wins = {tuple(b[k : k + m]) for k in range(len(b) - m + 1)} if m else set()
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) in wins:
                    hit |= set(range(k, k + m))
                    if item != "None":
                        found.add(item)
        out.append((doc_id or -1, len(w), sorted(hit), sorted(found)))
    return sorted(out)


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(*r, "k") for r in DOCS], "doc_id long, text string, words string")
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


def rows(df):
    return sorted((r.doc_id or -1, r.n_words, r.hit_words, r.items) for r in df.collect())


@pytest.mark.parametrize("bounds", [{}, {"max_runs": 0, "max_window_bytes": 0}])
def test_against_all_windows(tables, bounds):
    assert rows(find_contamination(*tables, **bounds)) == expected()


def test_empty_tables(tables):
    docs, items = tables
    assert find_contamination(docs.limit(0), items).count() == 0
    assert {(r.n_words > 0, *r.hit_words) for r in find_contamination(docs, items.limit(0)).collect()} == {(True,), (False,)}


def test_documents_or_spans_go(tables):
    docs, items = tables
    left = drop_contaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [3, 6, 7, 8, 9, 11]
    out = docs.where("doc_id = 2").select(without_words(F.col("text"), F.array(*(F.lit(n) for n in range(1, 11)))).alias("t"))
    assert out.first().t == "x, y"


def test_no_python_in_the_plan(tables):
    plan = find_contamination(*tables)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
