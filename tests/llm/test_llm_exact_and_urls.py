"""Exact deduplication by chunk recipes, and URL rules over aliases."""

import hashlib
from collections import defaultdict

import pytest
from oracle import connect, difference, duck_rows, spark_rows

from hazeframe.llm import chunk_recipes as recipes
from hazeframe.llm import url_rules
from hazeframe.llm.common import ROW
from hazeframe.llm.registry import ORACLES, QUERIES

DOCS = "doc_id long, text string"
PAGES = "page_id long, url string, html string"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, medium, name):
    rows = spark_rows(QUERIES[name](spark, medium))
    assert rows[1]
    assert difference(rows, duck_rows(connect(medium), ORACLES[name])) == ""


@pytest.mark.parametrize("size", [1, 16])
def test_exact_duplicates_of_odd_rows(spark, size):
    long = "x y " * 60_000
    rows = [(1, "Abc"), (2, "aBC"), (None, "abc"), (3, None), (4, ""), (5, long), (6, long.upper()), (6, long), (7, long + "z"), (8, "É"), (9, "é")]
    found = recipes.exact_duplicates(spark.createDataFrame(rows, DOCS), digest_bytes=size).collect()
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").encode().lower()].append(doc_id)
    want = []
    for key, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        want += [(i, best, len(ids), hashlib.sha256(key).hexdigest()) for i in ids]
    assert sorted(((r.doc_id or 0), r.keep_id, r.group_size, r.text_sha256) for r in found) == sorted((i or 0, *w) for i, *w in want)
    kept = [r for r in found if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)


def test_few_digest_bytes_change_nothing(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    short = recipes.exact_duplicates(docs, digest_bytes=1).orderBy(ROW).collect()
    assert short == recipes.exact_duplicates(docs).orderBy(ROW).collect()


def test_chunks_cover_the_text_and_move_with_it():
    words = " ".join(hashlib.sha256(str(i).encode()).hexdigest() for i in range(3000)).encode()
    ends = recipes.chunk_ends(words)
    sizes = [b - a for a, b in zip([0, *ends], ends)]
    assert ends[-1] == len(words) and all(recipes.LEAST <= s <= recipes.MOST for s in sizes[:-1])
    shifted = {b - 7 for b in recipes.chunk_ends(b"1234567" + words)}
    assert len(shifted & set(ends)) > 0.9 * len(ends)
    assert recipes.chunk_ends(b"") == [] and recipes.chunk_ends(b"a") == [1]
    assert recipes.chunk_ends(b"a" * 100_000)[-1] == 100_000


def test_stage_keeps_columns_and_one_of_each(spark):
    rows = [(1, "a", "x", 1), (1, "a", "x", 1), (2, "A", "y", 1), (3, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, group_size int")
    out = recipes.drop_exact_duplicates(spark, docs, "")
    assert out.schema == docs.schema and sorted(r.doc_id for r in out.collect()) == [2, 3]


def test_empty_tables(spark):
    assert recipes.exact_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    assert url_rules.url_verdicts(spark.createDataFrame([], PAGES)).count() == 0


def test_verdicts_pass_over_links(spark):
    link = '<link rel="canonical" href="{}">'.format
    rows = [
        (1, "https://a.example.org/x", link("https://b.example.com/en/1")),
        (2, "http://c.example.org/q?page=2&ref=x#t", '<meta http-equiv="refresh" content="0; url=/x2">'),
        (3, "http://c.example.org/x2", "<link href='//a.example.org/x' rel=canonical>"),
        (4, None, "x"),
        (5, "nourl", link("https://b.example.com/en/1")),
        (6, "http://www.z.example.org/p.html", link("http://www.example.com/en/2")),
        (7, "http://z.example.org/p", link("http://q.example.com/en/2")),
        (8, "http://y.example.org/", None),
        (8, "http://y.example.org/", None),
        (9, "HTTP://WWW.Example.COM/en/", link("mailto:x@y")),
        (10, "http://example.com/en", None),
        (11, "http://net/es/?a", None),
        (12, "http://ample.net#/es/", None),
    ]
    found = url_rules.url_verdicts(spark.createDataFrame(rows, PAGES)).collect()
    verdicts = sorted((r.page_id, r.rule, r.verdict) for r in found)
    assert verdicts == [
        (1, None, "block"), (2, None, "block"), (3, None, "block"), (4, None, "allow"), (5, None, "allow"),
        (6, None, "allow"), (7, None, "allow"), (8, None, "allow"), (8, None, "allow"),
        (9, "www.example.com/en/", "allow"), (10, "com/", "allow"), (11, "net/es/", "block"), (12, None, "allow"),
    ]
    assert {r.host for r in found if r.page_id in (4, 5)} == {""}


def test_all_links_count_and_equal_the_sql(spark, tmp_path):
    """Several links of a kind, entities, base addresses and odd ones, against the SQL with its recursive search."""
    import random

    canonical, graph, refresh = (
        '<link rel="canonical" href="{}">'.format, "<meta content='{}' property=og:url>".format, '<META HTTP-EQUIV="Refresh" content="5; URL={}">'.format
    )
    rows = [
        (1, "http://a.org/1", canonical("javascript:void(0)") + canonical("http://b.example.com/en/x")),
        (2, "http://a.org/2", graph("http://a.org/q?a=1&amp;b=2")),
        (3, "http://a.org/q?a=1&b=2", '<base href="http://net/fr/deep/">' + canonical("page")),
        (4, "http://a.org/4", "<base href='/sub/'><base href='http://net/es/'>" + refresh("x.html") + graph("y")),
        (5, "http://a.org/sub/x", ""), (6, "http://a.org/sub/y", None), (7, "https://m.a.org/sub/y/", canonical("//www.example.com/en/ok")),
        (8, "http://c.org", canonical("z") + graph("mailto:a@b") + refresh("?p=1")), (8, "http://c.org", canonical("z")), (9, "http://c.org/z", "x" * 300_000 + canonical("http://c.org/late")),
    ]
    random.seed(5)
    for i in range(100, 160):
        to = [f"http://r.org/{random.randrange(100, 190)}" for _ in range(random.randrange(3))]
        rows.append((i, f"http://r.org/{i}", "".join(random.choice([canonical, graph, refresh])(t) for t in to)))
    rows += [(200, "http://w.example.com/en/1", canonical("http://r.org/105"))]
    pages = spark.createDataFrame(rows, PAGES)
    found = url_rules.url_verdicts(pages)
    assert {r.page_id: r.verdict for r in found.collect() if r.page_id < 10} == {
        1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "allow", 9: "allow",
    }
    pages.coalesce(1).write.parquet(f"{tmp_path}/out")
    next(tmp_path.glob("out/*.parquet")).rename(tmp_path / "pages.parquet")
    assert difference(spark_rows(found), duck_rows(connect(str(tmp_path)), url_rules.ORACLE)) == ""


def test_components_by_brute_force(spark):
    import random

    from hazeframe.llm.components import components

    random.seed(3)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5), (7, None)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    got = components(spark.createDataFrame(edges, "p long, q long"), "p", "q").collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in root} and len(got) == len(root)
