"""Columns whose names clash with those that operators use, repeated rows, and definitions of scores."""

import numpy as np
import pytest

from hazeframe.llm import byte_bpe, dual_tree, licenses, ordinal, packing, secrets, spelling, toxicity, url_rules
from hazeframe.llm.license_rules import NOTICES, PHRASES, RULES

DOCS = "doc_id long, text string"
ROWS = [(1, "Licensed under the MIT License. Wonders wonders."), (1, "Licensed under the MIT License. Wonders wonders."), (None, None), (3, ""), (4, "you stupid idiot! token = 'Xk9fQ2mVb7z' " * 40)]
CLASH = [
    "doc_id", "text", "1 AS words", "'x' AS line", "2 AS hits", "3 AS kept", "4 AS n_words", "5 AS ids", "6 AS length", "'y' AS score", "7 AS label", "8 AS grade",
    "9 AS spans", "10 AS n", "11 AS word", "12 AS key", "13 AS tail", "14 AS sequence_id", "15 AS offset", "16 AS raw", "17 AS features", "18 AS calibrates", "19 AS __row__", "20 AS h",
]


def grades(spark):
    return spark.createDataFrame([(1, 0), (3, 1), (4, 2)], "doc_id long, grade long")


def labels(spark):
    return spark.createDataFrame([(1, 0), (4, 1), (4, 0)], "doc_id long, toxic int")


DOCUMENT_OPERATORS = {
    "license": lambda spark, docs: licenses.scan_licenses(docs),
    "packing": lambda spark, docs: packing.pack(docs).drop("sequence_id", "offset", "start"),
    "secrets": lambda spark, docs: secrets.find_secrets(docs),
    "quality": lambda spark, docs: ordinal.graded(docs, grades(spark)),
    "tokens": lambda spark, docs: byte_bpe.encode_texts(docs),
    "digests": lambda spark, docs: byte_bpe.token_digests(docs),
    "toxicity": lambda spark, docs: toxicity.toxicity(docs, labels(spark)),
    "spelling": lambda spark, docs: spelling.spelling_variants(docs),
}


@pytest.mark.parametrize("name", DOCUMENT_OPERATORS)
def test_other_columns_change_nothing(spark, name):
    docs = spark.createDataFrame(ROWS, DOCS).coalesce(1)
    run = DOCUMENT_OPERATORS[name]
    plain, clash = run(spark, docs), run(spark, docs.selectExpr(*CLASH))
    assert plain.columns == clash.columns
    rows = sorted(map(str, plain.collect()))
    assert rows == sorted(map(str, clash.collect())) and rows
    assert run(spark, docs.limit(0)).count() == 0


def test_other_columns_of_pages_and_vectors(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x", "<p>"), (1, "http://a.com/x", "<p>"), (2, None, None)], "page_id long, url string, html string")
    clash = pages.selectExpr("*", "1 AS key", "'h' AS host", "2 AS path", "3 AS best", "4 AS link", "5 AS component", "6 AS verdict", "7 AS base", "8 AS written")
    assert sorted(map(str, url_rules.url_verdicts(pages).collect())) == sorted(map(str, url_rules.url_verdicts(clash).collect()))
    vectors = spark.createDataFrame([(i, [float(i)] * 8, "a") for i in range(3)], "vec_id long, embedding array<float>, label string")
    clash = vectors.selectExpr("*", "1 AS vector", "2 AS dimension", "3 AS code", "4 AS rank")
    found = [sorted(map(str, dual_tree.with_label_errors(dual_tree.compress(df)[0]).collect())) for df in (vectors, clash)]
    assert found[0] == found[1] and len(found[0]) == 3


def test_quality_stage_keeps_all_columns(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, DOCS).selectExpr(*CLASH)
    spark.createDataFrame([(1, 0, 0), (4, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for stage in (ordinal.drop_poor, secrets.mask_stage):
        assert stage(spark, docs, str(tmp_path)).schema == docs.schema


def test_rules_written_by_hand():
    assert len(PHRASES) + len(NOTICES) >= 200 and len({(r.label, r.pattern) for r in RULES}) == len(RULES)


def test_fitted_grades_minimise_the_loss_by_definition():
    """Mean of -log P(grade) plus the penalty: no small change of a weight or threshold makes it less."""
    random = np.random.default_rng(3)
    rows, marks = [], []
    for _ in range(200):
        level = random.normal()
        rows.append((np.array([0, 1, 2]), np.array([1.0, level, 0.5])))
        marks.append(int(level + random.logistic() > -0.5) + int(level + random.logistic() > 1.5))
    model = ordinal.fit(rows, np.array(marks), 3, steps=4000)

    def loss(weights, thresholds):
        total = 0.0
        for (buckets, values), grade in zip(rows, marks):
            tails = [1.0, *(1 / (1 + np.exp(-(weights[buckets] @ values - t))) for t in thresholds), 0.0]
            total -= np.log(tails[grade] - tails[grade + 1])
        return total / len(rows) + ordinal.PENALTY * (weights**2).sum()

    best = loss(model.weights, model.thresholds)
    for step in (1e-2, -1e-2):
        for bucket in (1, 2):
            moved = model.weights.copy()
            moved[bucket] += step
            assert loss(moved, model.thresholds) > best - 1e-6
        for k in range(2):
            moved = model.thresholds.copy()
            moved[k] += step
            assert loss(model.weights, moved) > best - 1e-6


def test_toxicity_features_by_definition():
    lexicon = {"gronk": 3.0, "grub": 2.5, "gronk*": 1.5}
    text = "YOU gronk !! You are a GRUB and 1d10t, gronkish? soooo."
    words = ["you", "gronk", "you", "are", "a", "grub", "and", "d", "t", "gronkish", "soooo"]
    got = dict(zip(toxicity.FEATURES, toxicity.features(text, lexicon)))
    n = len(words)
    weights = [lexicon.get(w, 0.0) for w in words]
    letters = sum(c.isalpha() for c in text)
    want = {
        "lexicon_density": 2 / n, "lexicon_count": 2.0, "lexicon_distinct": 2.0, "lexicon_weight": sum(weights) / n, "lexicon_strongest": 3.0,
        "prefix_density": 2 / n, "prefix_strongest": 1.5, "seed_density": 0.0, "you_density": 2 / n, "near_you": 2 / n, "capitals": 8 / letters,
        "shouted": 2 / n, "exclaimed": 2 / n, "asked": 1 / n, "disguised": 1 / n, "disguised_lexicon": 1 / n, "letter_runs": 2 / n, "log_words": np.log1p(n),
        "punctuation": (len(text) - letters - text.count(" ")) / len(text),
    }
    want["prefix_density"], want["prefix_strongest"] = 2 / n, 1.5
    assert {k: pytest.approx(v) for k, v in want.items()} == got


def test_calibration_is_the_best_monotone_step_function(spark):
    """Pooling neighbours that violate the order, on the rows that calibrate."""
    random = np.random.default_rng(6)
    rows = []
    for i in range(600):
        toxic = i % 3 == 0
        words = [str(random.choice(["gronk", "grub", "plain", "table"] if toxic or random.random() < 0.2 else ["plain", "table", "river"])) for _ in range(8)]
        rows.append((i, " ".join(words), float(toxic)))
    labelled = spark.createDataFrame(rows, "doc_id long, text string, label double")
    scorer = toxicity.learn(labelled)
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    held = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0)
    measured = VectorAssembler(inputCols=list(toxicity.FEATURES), outputCol="features").transform(toxicity.measure(held, scorer.lexicon))
    raw = scorer.trees.transform(measured).select("doc_id", vector_to_array("probability")[1].alias("raw"), "label").toPandas()
    pooled = raw.groupby("raw")["label"].agg(["mean", "count"]).reset_index()
    blocks = []
    for _, r in pooled.iterrows():
        blocks.append([r["mean"], r["count"], [r["raw"]]])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            mean, count, members = blocks.pop()
            before = blocks[-1]
            before[0] = (before[0] * before[1] + mean * count) / (before[1] + count)
            before[1] += count
            before[2] += members
    want = {x: mean for mean, _, members in blocks for x in members}
    got = {r.doc_id: r.score for r in scorer.score(held.select("doc_id", "text")).collect()}
    for r in raw.itertuples():
        assert got[r.doc_id] == pytest.approx(want[r.raw], abs=1e-9)


def test_each_sampled_doc_id_is_learned_from_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "learn", lambda rows: seen.append(sorted(map(tuple, rows.collect()))) or toxicity.Scorer({}, None, None, 0.5))
    docs = spark.createDataFrame([(i, f"text {i} {j % 7}") for i in range(6) for j in range(500)], DOCS)
    given = spark.createDataFrame([(i, i % 2) for i in range(6)] * 3, "doc_id long, toxic int")
    toxicity.toxicity(docs, given).count()
    toxicity.toxicity(docs.orderBy("text", ascending=False), given).count()
    assert seen[0] == seen[1] and len(seen[0]) == len({r[0] for r in seen[0]}) <= 6
