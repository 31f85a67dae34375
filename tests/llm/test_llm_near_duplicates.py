"""Near-duplicate documents and vectors against brute force."""

import json
import subprocess
import sys
import textwrap
from pathlib import Path

import numpy as np
import pytest

from hazeframe.llm import buckets, itq, minhash

DOCS = "doc_id long, text string"
VECTORS = "vec_id long, embedding array<double>"


def labelled(nodes, links):
    """The smallest node that each one reaches."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {n: find(n) for n in nodes}


def word_shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(zip(words, words[1:], words[2:])) if len(words) > 2 else frozenset([tuple(words)] if words else [])


def brute_components(rows):
    sets = {i: word_shingles(t) for i, t in rows}
    ids = [i for i in sets if sets[i]]
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if 100 * min(len(x), len(y)) >= 85 * max(len(x), len(y)):
                shared = len(x & y)
                if 100 * shared >= 85 * (len(x) + len(y) - shared):
                    links.append((a, b))
    return labelled(sets, links), {i: len(s) for i, s in sets.items()}


def test_documents_by_brute_force(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    want, sizes = brute_components([(r.doc_id, r.text) for r in docs.collect()])
    found = minhash.op3(spark, medium).collect()
    assert {r.doc_id: r.component_id for r in found} == want and len(found) == len(want)
    assert {r.doc_id: r.n_shingles for r in found} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


@pytest.mark.parametrize("rounds", [True, False])
def test_chains_and_stars_of_near_copies(spark, monkeypatch, rounds):
    """A group in which few pairs are similar enough: small blocks, so that buckets are split. With rounds that let groups
    grow, and without, so that all blocks meet."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(160):
        words = base[:]
        for at in rng.integers(0, 150, rng.integers(0, 9)):
            words[at] = f"v{rng.integers(10**6)}"
        rows.append((i, " ".join(words)))
    for i in range(60):  # a chain: each differs from the next in one word only
        base[i] = f"c{i}"
        rows.append((1000 + i, " ".join(base)))
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "GROWING", 16)
    blocks = []
    whole = minhash.block_pairs_across

    def watched(*args):
        groups = whole(*args)
        blocks.append(groups.select("own").distinct().count())
        return groups

    monkeypatch.setattr(minhash, "block_pairs_across", watched)
    if not rounds:
        monkeypatch.setattr(minhash, "_forest", lambda batches: iter(()))
    want, _ = brute_components(rows)
    found = minhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id: r.component_id for r in found} == want
    assert rounds or max(blocks) > 3


@pytest.mark.parametrize("block", [4, 16, 1000])
def test_all_members_with_different_labels_meet(spark, block):
    random = np.random.default_rng(6)
    rows = [(int(k), m, int(random.choice([1, 2, 3, 4, 100 + m]))) for k in range(3) for m in range(60)]
    rows += [(7, m, 1) for m in range(50)] + [(8, 1, 1)]  # one label only: nothing to compare
    members = spark.createDataFrame(rows, "bucket long, node long, component long")
    found = buckets.block_pairs_across(members, "bucket", "node", "component", block).collect()
    groups, met = {}, set()
    for r in found:
        groups.setdefault((r.bucket, r.pair), []).append(r)
    for (bucket, _), own in groups.items():
        assert len(own) <= 6 * block
        met |= {(bucket, a.node, b.node) for a in own for b in own if a.component != b.component and (a.own != b.own or a.same)}
    want = {(k, a, b) for k, a, x in rows for j, b, y in rows if k == j and x != y}
    assert met == want and not any(r.bucket in (7, 8) for r in found)


def test_shuffles_grow_with_a_group_of_near_copies(tmp_path):
    """12,000 near copies of one text, one word changed in each: bytes shuffled by the event log, in sketches of the group."""
    n = 12_000
    script = f"""
        import sys
        sys.path.insert(0, {str(Path(__file__).resolve().parents[2])!r})
        import numpy as np
        from hazeframe.llm import minhash
        from hazeframe.session import get_spark
        conf = {{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g"}}
        conf |= {{"spark.checkpoint.dir": "{tmp_path}/checkpoints", "spark.eventLog.enabled": "true", "spark.eventLog.dir": "{tmp_path}"}}
        conf |= {{"spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"}}
        spark = get_spark("child", "local[8]", **conf)
        random = np.random.default_rng(1)
        texts = [[f"w{{j}}" for j in range(60)] for _ in range({n})]
        for i, words in enumerate(texts):
            words[int(random.integers(60))] = f"v{{i}}"
        docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(8)
        docs.write.parquet("{tmp_path}/docs")
        print("GROUPS", minhash.near_duplicates(spark.read.parquet("{tmp_path}/docs")).select("component_id").distinct().count())
        spark.stop()
    """
    child = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, timeout=300, text=True)
    assert "GROUPS 1\n" in child.stdout, child.stderr[-2000:]
    written = 0
    for log in tmp_path.glob("local-*"):
        for line in log.read_text().splitlines():
            if '"SparkListenerTaskEnd"' in line:
                metrics = json.loads(line).get("Task Metrics") or {}
                written += (metrics.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
    assert 0 < written <= 10 * n * minhash.SKETCH.itemsize


def test_odd_documents(spark):
    rows = [
        (1, "a b c d e"), (2, "A b  c\td e"), (None, "a b c d e"), (3, None), (4, ""), (5, "x"), (6, "X"), (7, "x y"),
        (8, "  \n"), (9, "x " * 50_000), (9, "q w e r"), (10, "q w e r"), (11, "é"), (12, "É"),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect())
    assert found == [
        (0, 3, 1, False), (1, 3, 1, True), (2, 3, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 1, 5, True), (6, 1, 5, False),
        (7, 1, 7, True), (8, 0, 8, True), (9, 1, 9, True), (9, 2, 9, True), (10, 2, 9, False), (11, 1, 11, True), (12, 1, 12, True),
    ]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
    extra = docs.selectExpr("doc_id", "text", "1 AS node", "'x' AS digest", "2 AS component_id")
    kept = minhash.drop_near_duplicates(spark, extra, "")
    assert kept.schema == extra.schema and kept.count() == 10
    numbered = docs.selectExpr("doc_id", "text", "7 AS __row__", "8 AS __row___")
    kept = minhash.drop_near_duplicates(spark, numbered, "")
    assert kept.schema == numbered.schema and [tuple(r)[2:] for r in kept.collect()] == [(7, 8)] * 10


def test_bayesian_bounds():
    """The bounds lose a pair at the threshold with about the chosen probability, and prune dissimilar pairs."""
    bounds = minhash.least_matches(24, 120, 0.85, 1e-3)
    rng = np.random.default_rng(0)

    def passes(similarity, n=200_000):
        seen = (rng.random((n // 10, 120)) < similarity).cumsum(axis=1)[:, 23::24]
        return (seen >= np.array(bounds)).all(axis=1).mean()

    assert passes(0.85) > 0.99 and passes(0.9) > 0.999 and passes(0.5) < 0.001


def test_bitmap_never_drops_a_link():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    sketches, sets = [], []
    for _ in range(200):
        keep = rng.random(3000) < rng.uniform(0.8, 1.0)
        sets.append(np.unique(pool[keep]))
        sketches.append(minhash.sketch(sets[-1]))
    table = np.frombuffer(b"".join(sketches), dtype=minhash.SKETCH)
    left, right = np.triu_indices(200, 1)
    alive = set(minhash.survivors(table, left, right).tolist())
    for k, (a, b) in enumerate(zip(left, right)):
        shared = len(np.intersect1d(sets[a], sets[b]))
        if 100 * shared >= 85 * (len(sets[a]) + len(sets[b]) - shared):
            assert k in alive


def brute_vectors(ids, matrix, least=0.9):
    fit = np.isfinite(matrix).all(axis=1) & (matrix != 0).any(axis=1)
    unit = matrix / np.where(fit, np.linalg.norm(np.where(np.isfinite(matrix), matrix, 0), axis=1), 1)[:, None]
    close = (unit @ unit.T >= least) & fit & fit[:, None]
    np.fill_diagonal(close, False)
    links = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(close)))]
    return dict(zip(ids, close.sum(axis=1).tolist())), labelled(ids, links)


@pytest.fixture(scope="module")
def clustered():
    """Pairs all over the allowed angles, and one group larger than a block."""
    rng = np.random.default_rng(1)
    base = rng.standard_normal((900, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    aside = rng.standard_normal((900, 64))
    aside -= (aside * base).sum(axis=1)[:, None] * base
    aside /= np.linalg.norm(aside, axis=1)[:, None]
    cosine = rng.uniform(0.88, 1.0, 900)[:, None]
    near = base * cosine + aside * np.sqrt(1 - cosine**2)
    group = base[:1] + 0.02 * rng.standard_normal((600, 64))
    return np.vstack([base, near, group])


def test_vectors_by_brute_force(spark, clustered):
    ids = list(range(len(clustered)))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, clustered)], VECTORS)
    counts, _ = brute_vectors(ids, clustered)
    found = {r.vec_id: r for r in itq.near_vectors(vectors).collect()}
    assert all(found[i].n_links <= counts[i] for i in ids)
    assert sum(r.n_links for r in found.values()) >= 0.98 * sum(counts.values())
    pairs = [(i, i + 900) for i in range(900) if clustered[i] @ clustered[i + 900] >= 0.9]
    assert sum(found[a].component_id == found[b].component_id for a, b in pairs) >= 0.95 * len(pairs)


def test_test_vectors_by_brute_force(spark, medium):
    rows = spark.read.parquet(f"{medium}/embeddings.parquet").collect()
    counts, labels = brute_vectors([r.vec_id for r in rows], np.array([r.embedding for r in rows], dtype=float))
    found = itq.op10(spark, medium).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == {i: (counts[i], labels[i]) for i in counts}


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.001]), (None, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]),
        (6, [None, 1.0]), (7, [1e200, 1.0]), (8, [0.0, 1e-200]), (9, []), (10, [inf, 0.0]),
    ]
    vectors = spark.createDataFrame(rows, VECTORS)
    found = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in itq.near_vectors(vectors).collect())
    assert found == [
        (0, 4, 1, False), (1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), (3, 0, 3, True), (4, 0, 4, True),
        (5, 0, 5, True), (6, 0, 6, True), (7, 4, 1, False), (8, 0, 8, True), (9, 0, 9, True), (10, 0, 10, True),
    ]
    assert itq.near_vectors(vectors.limit(0)).count() == 0
    assert itq.near_vectors(vectors.where("vec_id = 4")).first().kept
    extra = vectors.selectExpr("*", "1 AS hash", "2 AS node", "'x' AS copies", "3 AS n_links", "4 AS component", "5 AS dimension")
    assert sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in itq.near_vectors(extra).collect()) == found


def test_each_dimension_links_with_itself(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [1.0, 0.0, 0.0]), (4, [1.0, 0.0, 0.01]), (5, [1.0]), (6, [0.0, 1.0, 0.0])]
    found = itq.near_vectors(spark.createDataFrame(rows, VECTORS)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == [(1, 1, 1), (2, 1, 1), (3, 1, 3), (4, 1, 3), (5, 0, 5), (6, 0, 6)]


def test_copies_teach_no_rotation(spark, monkeypatch):
    """5,200 copies of one vector beside 2,000 distinct ones: the sample holds distinct vectors and keys stay long."""
    learned = []
    whole = itq.Codes

    def watched(sample, least):
        learned.append((len(np.unique(sample, axis=0)), whole(sample, least)))
        return learned[-1][1]

    monkeypatch.setattr(itq, "Codes", watched)
    random = np.random.default_rng(3)
    matrix = np.vstack([np.repeat(random.standard_normal((1, 64)), 5200, axis=0), random.standard_normal((2000, 64))])
    matrix[5200:5300] = matrix[5300:5400] + 0.01 * random.standard_normal((100, 64))
    vectors = spark.createDataFrame(list(enumerate(matrix.tolist())), VECTORS)
    found = {r.vec_id: (r.n_links, r.component_id) for r in itq.near_vectors(vectors).collect()}
    assert learned[0][0] == 2001 and learned[0][1].bits >= 21 and learned[0][1].recall >= itq.RECALL
    assert all(found[i] == (5199, 0) for i in range(5200))
    assert sum(found[i][0] for i in range(5200, 7200)) == 200


def test_keys_stay_long_where_recall_is_out_of_reach():
    """Vectors that hardly differ but for one direction: more rotations, not shorter keys, and the recall is told."""
    random = np.random.default_rng(2)
    sample = np.array([[1.0, *[0.0] * 15]]) + 1e-9 * random.standard_normal((300, 16))
    codes = itq.Codes(sample / np.linalg.norm(sample, axis=1, keepdims=True))
    assert codes.bits >= itq.LEAST_BITS and len(codes.rotations) <= itq.ROTATIONS_AT_LAST and 0 <= codes.recall <= 1


@pytest.mark.parametrize("shared", [0.5, 0.85])
def test_vectors_that_share_a_direction(spark, shared):
    """Pairs just above the threshold, of vectors whose cosine with unrelated ones is about `shared`."""
    random = np.random.default_rng(7)
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    noise = unit(random.standard_normal((600, 64)))
    left = unit(np.sqrt(shared) * np.eye(64)[:1] + np.sqrt(1 - shared) * unit(noise * (np.arange(64) > 0)))
    across = random.standard_normal(left.shape)
    across = unit(across - np.einsum("ij,ij->i", across, left)[:, None] * left)
    matrix = np.vstack([left, 0.9001 * left + np.sqrt(1 - 0.9001**2) * across])
    links, _ = brute_vectors(range(len(matrix)), matrix)
    vectors = spark.createDataFrame(list(enumerate(matrix.tolist())), "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in itq.near_vectors(vectors).collect()}
    assert sum(links.values()) >= 1200 and all(found[i] <= n for i, n in links.items())
    assert sum(found.values()) >= 0.93 * sum(links.values())
