"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

The lexicon is learned from the training texts of a bounded sample, besides a few words that it starts with; the features
are densities and rates, so that the length of a text doesn't matter by itself. Trees are fitted on two thirds of the
sample and calibrated on the rest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe.llm.common import cut_lineage, id_and_text, slices, table

#: Labelled texts that are used for learning, at most, chosen by hash of their doc_id.
SAMPLE = 12_000
#: Words of the learned lexicon, and in how many texts a word must occur for it.
LEXICON, LEAST_TEXTS = 2_000, 5
#: Score from which a text is predicted toxic.
THRESHOLD = 0.3
TREES, DEPTH = 20, 4
#: Insults to begin with, in the languages of the corpora this was written for.
SEED = frozenset(
    """idiot idiots moron morons stupid dumb loser losers scum trash clown pathetic worthless disgusting ugly fool jerk
    shut hate kill die damn hell crap dummkopf idiotisch blöd hässlich wertlos abschaum verlierer imbécile idiote stupide
    ordure nul débile perdant minable idiota estúpido estúpida basura imbécil patético inútil perdedor asqueroso""".split()
)
YOU = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros".split())
WORD = re.compile(r"[^\W\d_]+")
#: Letters said by other signs, or parted by them, as in "1d10t" and "s.t.u.p.i.d".
SAID_AS = str.maketrans("013457@$!", "oieastasi")
DISGUISED = re.compile(r"\b(?=\w*[0-9@$!])(?=\w*[^\W\d_])[\w@$!]{3,}\b|\b(?:\w[.\-*_]){2,}\w\b|\w\*{1,}\w")
FEATURES = (
    "lexicon_density", "lexicon_count", "lexicon_distinct", "lexicon_weight", "lexicon_strongest", "prefix_density", "prefix_strongest",
    "seed_density", "near_you", "you_density", "capitals", "shouted", "exclaimed", "asked", "punctuation", "disguised",
    "disguised_lexicon", "letter_runs", "log_words",
)
#: Letters at a word's beginning that are weighed as well, for inflected and made-up forms.
PREFIX = 5


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2


def _terms(text: str) -> set[str]:
    words = set(WORD.findall(text.lower()))
    return words | {w[:PREFIX] + "*" for w in words if len(w) > PREFIX}


def features(text: str, lexicon: dict[str, float]) -> list[float]:
    """The values of FEATURES; all of the text counts, and an empty one has zeros."""
    words = WORD.findall(text)
    if not words:
        return [0.0] * len(FEATURES)
    low = [w.lower() for w in words]
    weights = [lexicon.get(w, 0.0) for w in low]
    hits = [i for i, w in enumerate(weights) if w > 0]
    starts = [lexicon.get(w[:PREFIX] + "*", 0.0) for w in low]
    you = [i for i, w in enumerate(low) if w in YOU]
    seeds = [i for i, w in enumerate(low) if w in SEED]
    insults = sorted({*hits, *seeds})
    near, at = 0, 0
    for i in you:
        while at < len(insults) and insults[at] < i - 5:
            at += 1
        near += at < len(insults) and insults[at] <= i + 5
    letters = sum(map(len, words))
    disguised = DISGUISED.findall(text) if any(c in text for c in "013457@$!.*-_") else []
    plain = [re.sub(r"[^\w]|_", "", d).lower().translate(SAID_AS) for d in disguised]
    n = len(words)
    return [
        len(hits) / n,
        float(len(hits)),
        float(len({low[i] for i in hits})),
        sum(weights) / n,
        max(weights),
        sum(s > 0 for s in starts) / n,
        max(starts),
        len(seeds) / n,
        near / n,
        len(you) / n,
        sum(c.isupper() for c in text) / letters,
        sum(w.isupper() and len(w) > 2 for w in words) / n,
        text.count("!") / n,
        text.count("?") / n,
        (len(text) - letters - text.count(" ")) / len(text),
        len(disguised) / n,
        sum(p in SEED or lexicon.get(p, 0.0) > 0 for p in plain) / n,
        sum(1 for a, b, c in zip(text, text[1:], text[2:]) if a == b == c and a.isalpha()) / n,
        float(np.log1p(n)),
    ]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each text the terms it holds, with its label."""
    for batch in slices(batches, 64):
        terms, labels = [], []
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            own = _terms(text)
            terms += own
            labels += [label] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(labels, pa.float64())], ["term", "label"])


def _measured(batches: Iterator[pa.RecordBatch], lexicon: dict[str, float]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = [features(t, lexicon) for t in batch.column("text").to_pylist()]
        arrays = [pa.array(column, pa.float64()) for column in zip(*rows)]
        kept = [name for name in batch.schema.names if name != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), *arrays], [*kept, *FEATURES])


def measure(rows: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """`rows` with FEATURES in place of text."""
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text"]
    return rows.mapInArrow(partial(_measured, lexicon=lexicon), ", ".join([*kept, *(f"{f} double" for f in FEATURES)]))


def learn_lexicon(training: DataFrame, most: int = LEXICON) -> dict[str, float]:
    """Terms that mark toxic texts, with their log odds: at most `most`, those that tell most first."""
    sizes = training.agg(F.sum("label").alias("toxic"), F.count("*").alias("n")).first()
    toxic, clean = float(sizes["toxic"] or 0), float(sizes["n"] - (sizes["toxic"] or 0))
    counts = training.select("text", "label").mapInArrow(_counted, "term string, label double")
    counts = counts.groupBy("term").agg(F.sum("label").alias("toxic"), F.count("*").alias("n")).where(F.col("toxic") >= LEAST_TEXTS)
    odds = F.log(((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("n") - F.col("toxic") + 0.5) / (clean + 1)))
    chosen = counts.withColumn("odds", odds).where("odds > 2").orderBy(F.desc(F.col("toxic") * F.col("odds")), "term").limit(most)
    return {r["term"]: float(r["odds"]) for r in chosen.select("term", "odds").collect()}


class Scorer:
    """A fitted lexicon, forest and calibration."""

    def __init__(self, lexicon: dict[str, float], trees: GBTClassificationModel | None, steps: IsotonicRegressionModel | None, rate: float):
        self.lexicon, self.trees, self.steps, self.rate = lexicon, trees, steps, rate

    def score(self, rows: DataFrame) -> DataFrame:
        """`rows` (doc_id, text) with score in place of text."""
        if self.trees is None:
            return rows.drop("text").withColumn("score", F.lit(self.rate))
        measured = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(measure(rows, self.lexicon))
        raw = self.trees.transform(measured).withColumn("raw", vector_to_array("probability")[1]).select("doc_id", "raw")
        return self.steps.setFeaturesCol("raw").setPredictionCol("score").transform(raw).select("doc_id", "score")


def learn(labelled: DataFrame) -> Scorer:
    """A scorer from (doc_id, text, label) rows; label is 0.0 or 1.0. A third of the rows, by hash of doc_id, calibrates.

    With fewer than five rows of either label in one of the two parts, the score is the share of label 1 (0.5 without
    rows).
    """
    rows = cut_lineage(labelled.withColumn("calibrates", F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0))
    fitting = rows.where("NOT calibrates")
    counts = {(r["calibrates"], r["label"]): r["count"] for r in rows.groupBy("calibrates", "label").count().collect()}
    total = sum(counts.values())
    if min(counts.get((c, x), 0) for c in (False, True) for x in (0.0, 1.0)) < 5:
        return Scorer({}, None, None, sum(n for (_, x), n in counts.items() if x == 1) / total if total else 0.5)
    lexicon = learn_lexicon(fitting)
    measured = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(measure(rows, lexicon))
    measured = cut_lineage(measured.select("doc_id", "label", "calibrates", "features").coalesce(2))
    forest = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=1, minInstancesPerNode=10, maxBins=32, cacheNodeIds=False)
    trees = forest.fit(measured.where("NOT calibrates"))
    raw = trees.transform(measured.where("calibrates")).select(vector_to_array("probability")[1].alias("raw"), "label")
    steps = IsotonicRegression(featuresCol="raw", labelCol="label").fit(raw)
    return Scorer(lexicon, trees, steps, 0.5)


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """doc_id, held_out, score, predicted for each row of `docs`.

    Only labels of rows outside the held-out quarter (crc32 of doc_id as text, mod 4, is 2) are learned from; null
    labels are left out. Each doc_id of the sample is learned from once: its text of smallest hash, toxic if a label says
    so. Null text counts as empty, and
    empty texts are scored like others; null doc_ids are not held out. predicted is 1 from a score of THRESHOLD on.
    """
    rows = id_and_text(docs, doc_id, text)
    marked = labels.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("double").alias("label"))
    # The labels' side is cut to the sample before texts are joined to it.
    marked = marked.where(F.col("label").isin(0.0, 1.0) & ~held_out(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg(F.max("label").alias("label"))
    marked = cut_lineage(marked.orderBy(F.xxhash64(F.col("doc_id")), "doc_id").limit(SAMPLE))
    texts = rows.join(F.broadcast(marked), "doc_id").groupBy("doc_id", "label")
    scorer = learn(texts.agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first")).select("doc_id", "first.text", "label"))
    return scorer.score(rows).select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op9(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
