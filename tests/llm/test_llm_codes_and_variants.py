"""Vector codes, nearest vectors and spelling variants against their definitions."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from oracle import connect, difference, duck_rows, spark_rows

from hazeframe.llm import dual_tree, one_bit, spelling
from hazeframe.llm.itq import usable

VECTORS = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize(("query", "sql"), [(dual_tree.op11, dual_tree.ORACLE), (one_bit.op12, one_bit.ORACLE)])
def test_queries_equal_their_sql(spark, medium, query, sql):
    assert difference(spark_rows(query(spark, medium)), duck_rows(connect(medium), sql)) == ""


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """Lloyd's rounds by definition, with Python's integers."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    vectors = [[int(np.floor(4096 * x)) for x in v] for _, v in rows]
    width = len(vectors[0]) // parts
    cut = [[v[p * width : (p + 1) * width] for v in vectors] for p in range(parts)]
    books = [[list(x) for x in own[:entries]] for own in cut]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for own, book in zip(cut, books):
            groups = {}
            for x in own:
                groups.setdefault(near(x, book)[1], []).append(x)
            for e, members in groups.items():
                book[e] = [sum(c) // len(members) for c in zip(*members)]
    found = [[near(own[i], book) for own, book in zip(cut, books)] for i in range(len(rows))]
    text = ",".join(str(c) for book in books for e in book for c in e)
    return sorted((r[0] or 0, bytes(e for _, e in f), sum(d for d, _ in f)) for r, f in zip(rows, found)), hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("kind", ["spread", "clusters", "copies", "few", "lattice"])
def test_codes_by_definition(spark, kind, monkeypatch):
    random = np.random.default_rng(3)
    if kind == "spread":
        matrix = random.standard_normal((700, 16))
    elif kind == "clusters":
        matrix = random.standard_normal((20, 16))[random.integers(20, size=900)] + 0.01 * random.standard_normal((900, 16))
    elif kind == "copies":  # one vector holds a third of the rows, and the first entries are equal
        matrix = np.vstack([np.repeat(random.standard_normal((1, 16)), 300, axis=0), random.standard_normal((600, 16))])
    elif kind == "few":
        matrix = random.standard_normal((5, 16))
    else:  # many equal distances
        matrix = random.integers(-1, 2, (600, 16)) / 4096
    rows = [(i, v) for i, v in enumerate(matrix.tolist())]
    monkeypatch.setattr(dual_tree, "CHUNK", 256)
    df = spark.createDataFrame([(*r, 0) for r in rows], VECTORS).repartition(3)
    coded, books = dual_tree.compress(df)
    want, digest = plain_codes(rows)
    found = coded.collect()
    assert sorted((r.vec_id, bytes(r.code), r.error) for r in found) == want
    assert {r.codebooks_sha256 for r in found} == {digest}
    integers = {i: np.floor(4096 * np.array(v)) for i, v in rows}
    for r in found[:20]:
        assert ((dual_tree.decoded(bytes(r.code), books[16]) - integers[r.vec_id]) ** 2).sum() == r.error


def test_whole_nodes_are_assigned_by_their_sums():
    """On separate clusters nearly no part is compared alone."""
    random = np.random.default_rng(1)
    points = dual_tree.integers(np.repeat(random.standard_normal((8, 8)), 500, axis=0) + 1e-3 * random.standard_normal((4000, 8)))
    tree, book = dual_tree.PartTree.over(points), dual_tree.EntryTree(points[::500][:8])
    whole, places, _ = dual_tree.settled(tree, book)
    assert len(places) < 400 and sum((np.diff(tree.bounds(level, n), axis=0)).sum() for level, n, _ in whole) == 4000 - len(places)


def test_odd_vectors_in_codes(spark):
    inf, nan = float("inf"), float("nan")
    good = [0.5, -0.00001, 0.25, 1.0, -1.0, 0.0, 2.0, 3.0]
    rows = [
        (1, good, 1), (1, good, 1), (None, good, None), (2, None, 1), (3, [nan, *good[1:]], 1), (4, [None, *good[1:]], 1), (5, [inf] * 8, None),
        (6, [0.0] * 8, None), (7, [], 2), (8, [1.0, 2.0], 2), (9, [1e300, -1e300, *good[2:]], 3), (10, good[:3], None),
    ]
    df = spark.createDataFrame(rows, VECTORS)
    coded, books = dual_tree.compress(df.selectExpr("*", "1 AS error", "'x' AS code", "2 AS dimension"))
    found = dual_tree.with_label_errors(coded).collect()
    assert sorted(r.vec_id or 0 for r in found) == [0, 1, 1, 6, 7, 8, 9, 10] and sorted(books) == [0, 2, 3, 8]
    assert {r.error for r in found} == {0} and {r.label_error for r in found} == {0}
    assert len({r.codebooks_sha256 for r in found}) == 4
    assert dual_tree.compress(df.limit(0))[0].count() == 0 and dual_tree.compress(df.where("vec_id = 2"))[1] == {}


def brute_nearest(rows, queries, count=10):
    """(query_id, rank, vec_id, score): rows are (vec_id, vector)."""
    found = []
    for q in queries:
        scored = []
        for i, (vec_id, v) in enumerate(rows):
            if i != q:
                total = 0.0
                for a, b in zip(v, rows[q][1]):
                    total += (a - b) * (a - b)
                scored.append((np.sqrt(total), vec_id is None, vec_id or 0, i))
        found += [(rows[q][0], k + 1, None if none else vec_id, s) for k, (s, none, vec_id, _) in enumerate(sorted(scored)[:count])]
    return sorted(found, key=lambda f: f[:2])


def searched(spark, rows, extra=(), count=10, parts=3):
    df = spark.createDataFrame([(*r, 0) for r in [*rows, *extra]], VECTORS).repartition(parts)
    queries = usable(df, "vec_id", "embedding").where("fit AND vec_id % 100 = 0").select("__row__", "vec_id", "vector")
    return sorted((tuple(r) for r in one_bit.nearest(df, queries, count).collect()), key=lambda f: f[:2])


@pytest.mark.parametrize("kind", ["spread", "clusters", "copies", "shared direction", "near copies"])
def test_nearest_by_brute_force(spark, kind, monkeypatch):
    random = np.random.default_rng(8)
    matrix = random.standard_normal((3000, 32))
    if kind == "clusters":
        matrix = random.standard_normal((40, 32))[random.integers(40, size=3000)] + 0.1 * matrix
    elif kind == "copies":  # a third of all rows are one vector; others repeat in pairs
        matrix[:1000] = matrix[0]
        matrix[1000:2000:2] = matrix[1001:2000:2]
    elif kind == "shared direction":
        matrix[:, 0] += 20
    elif kind == "near copies":
        matrix[:1000] = matrix[0] + 1e-6 * random.standard_normal((1000, 32))
    monkeypatch.setattr(one_bit, "BLOCK", 300)
    monkeypatch.setattr(one_bit, "QUERIES", 7)
    monkeypatch.setattr(one_bit, "SHARE", 20)
    rows = list(enumerate(matrix.tolist()))
    want = brute_nearest(rows, range(0, 3000, 100))
    found = searched(spark, rows)
    assert len(found) == len(want) == 300
    exact = sum(f == w for f, w in zip(found, want))
    assert exact >= 299, exact


def test_codes_rule_out_most_vectors(monkeypatch):
    """The bounds leave few vectors to compare exactly, and hold."""
    random = np.random.default_rng(5)
    vectors = random.standard_normal((4000, 64))
    index = one_bit.Index(vectors[:200], 1)
    rest = vectors - index.centres[0]
    length = np.linalg.norm(rest, axis=1)
    turned = rest / length[:, None] @ index.turn
    codes, scalars = np.packbits(turned >= 0, axis=1), np.stack([length, np.abs(turned).sum(axis=1) / np.sqrt(index.bits)])
    compared = []
    exact = one_bit.exact
    monkeypatch.setattr(one_bit, "exact", lambda a, b: compared.append(len(a)) or exact(a, b))
    wanted = random.standard_normal((50, 64))
    query, node, score = one_bit.search_block(
        np.arange(4000), one_bit.signs_of(codes), scalars, vectors, index.centres[0], index.turn, wanted, np.full(50, np.inf), 11
    )
    assert sum(compared) < 0.15 * 50 * 4000
    true = np.argsort(((wanted[:, None] - vectors[None]) ** 2).sum(axis=2), axis=1)[:, :11]
    assert sum(set(node[query == i]) == set(true[i]) for i in range(50)) >= 49


def test_odd_vectors_in_search(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.5]), (100, [1.0, 0.5]), (None, [1.0, 0.25]), (7, [-0.0, 3.0]), (200, [0.0, 3.0]), (8, [1e200, 0.0])]
    none = [(300, None), (400, [0.0, 0.0]), (500, [nan, 1.0]), (600, [None, 1.0]), (700, [inf, 0.0]), (800, [])]
    other = [(900, [1.0, 1.0, 1.0]), (901, [1.0, 1.0, 2.0])]
    want = brute_nearest(rows, [0, 1, 2, 5], 5) + [(900, 1, 901, 1.0)]
    found = searched(spark, rows, none + other, count=5)
    assert sorted(found, key=str) == sorted(want, key=str)
    assert searched(spark, rows[:1]) == [] and searched(spark, none) == []
    extra = spark.createDataFrame([(*r, 0) for r in rows], VECTORS).selectExpr("*", "1 AS node", "'x' AS hash", "2 AS query", "3 AS rank")
    queries = usable(extra, "vec_id", "embedding").where("vec_id = 200").select("__row__", "vec_id", "vector")
    assert one_bit.nearest(extra, queries, 1).collect() == [(200, 1, 7, 0.0)]


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and (a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :])


def brute_near(counts):
    words = sorted(counts)
    near = {w: [] for w in words}
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if one_apart(a, b):
                near[a].append(b)
                near[b].append(a)
    return near


def brute_variants(rows):
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    counts = {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}
    near, form = brute_near(counts), {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None
    rows = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return sorted(rows, key=str)


def test_variants_by_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = spelling.op13(spark, small).collect()
    assert sorted(map(tuple, found), key=str) == brute_variants([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("most", [4096, 12, 2])
def test_partitions_of_any_size_give_all_near_words(spark, most):
    """Few letters, so that edits may stand in several places; small partitions, so that windows are cut to one place."""
    random = np.random.default_rng(2)
    words = {"".join(random.choice(list("abé"), random.integers(2, 9))) for _ in range(400)}
    words |= {"prefix" + "".join(random.choice(list("abcdefgh"), 4)) for _ in range(300)} | {"a" * n for n in range(2, 12)}
    counts = {w: int(random.integers(2, 50)) for w in sorted(words)}
    near = brute_near(counts)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {r.word: (r.n_near, r.best_n, r.best) for r in spelling.near_words(df, most).collect()}
    best = {w: min(o, key=lambda x: (-counts[x], x)) for w, o in near.items() if o}
    assert found == {w: (len(near[w]), counts[b], b) for w, b in best.items()}


def test_acceptor_is_minimal():
    acceptor = spelling.Acceptor(["tap", "taps", "top", "tops", ""])
    assert len(acceptor.arcs) == 5 and sum(acceptor.final) == 3
    assert sorted(spelling.OneEdit(acceptor).pairs()) == [("tap", "taps"), ("tap", "top"), ("taps", "tops"), ("top", "tops")]


def test_odd_texts_in_variants(spark, monkeypatch):
    long = "q" * 9000
    rows = [
        (1, None), (2, ""), (3, "Wonders wonders WONDERS"), (3, "Wonders wonders WONDERS"), (None, "wonders " * 20), (4, "wonderz wonderz"),
        (5, f"{long} {long} x{long} {long}y {long}z x{long} {long}z"), (6, "ÀÉÎÕÜÿ× àéîõüÿ÷ ÀÉÎÕÜÿ× " * 3), (7, "seven7seven sevenlo " * 70_000),
    ]
    monkeypatch.setattr(spelling, "STRETCH", 1000)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    extra = docs.selectExpr("doc_id", "text", "'x' AS word", "1 AS n", "2 AS key", "3 AS size")
    assert sorted(map(tuple, spelling.spelling_variants(extra).collect()), key=str) == brute_variants(rows)
    assert spelling.spelling_variants(docs.limit(0)).count() == 0
