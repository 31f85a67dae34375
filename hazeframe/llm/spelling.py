"""Spelling variants: pairs of words one edit apart, found by composing finite-state machines.

The vocabulary is an acceptor A; T is the transducer that copies its input but for one inserted, deleted or replaced code
point. The pairs that A o T o A accepts are the near words. The composition is cut by its initial states: outside a window
of places that holds the edit, two near words are equal, so those that share what stands before and after a window form a
partition of their own, whose composition starts where the common beginning ends. Of one window's two halves one is free of
the edit as well; partitions that are too large are therefore cut again into two with half the window each, down to
windows of one place, where the alphabet bounds them. Each pair lies in one partition only.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe.llm.buckets import gathered, whole_groups
from hazeframe.llm.common import cut_lineage, id_and_text, spread, table

#: Least length of a word in code points, and least number of occurrences.
SHORTEST, RAREST = 7, 2
#: One in so many hashes loses a code point.
SLIP = 31
#: A near word is a form if it occurs at least so many times as often.
RATIO = 10
#: Words of a partition, and places of a window that several words share, beyond which the window is cut.
MOST, WIDEST = 4096, 2048
#: Distinct words that a task counts before it sends them on, and characters of a text that it searches at once.
HELD, STRETCH = 200_000, 1 << 20

_RUNS = re.compile(f"[a-zÀ-ÿ]{{{SHORTEST},}}")
_LETTERS = re.compile("[a-zÀ-ÿ]*")


def runs(text: str) -> Iterator[str]:
    """Maximal runs of letters, A-Z lower-cased, of SHORTEST code points or more. Very long texts are searched piece by piece."""
    text = text.encode().lower().decode()
    start = 0
    while start < len(text):
        end = _LETTERS.match(text, min(len(text), start + STRETCH)).end()
        yield from _RUNS.findall(text, start, end)
        start = end


def slipped(run: str, seed: int) -> str:
    """The run, or where the hash says so the run without one code point; `seed` is the CRC-32 of what stands before it."""
    h = zlib.crc32(run.encode(), seed)
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and how often they occur in the rows of a task, a bounded number at a time."""
    seen: Counter[str] = Counter()

    def flushed() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
        seen.clear()
        return batch

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for run, n in Counter(runs(text)).items():
                word = slipped(run, seed)
                if len(word) >= SHORTEST:
                    seen[word] += n
            if len(seen) >= HELD:
                yield flushed()
    if seen:
        yield flushed()


class Acceptor:
    """The minimal deterministic acceptor of a set of words: `arcs` of each state, `final` states, `start`.

    Built from the ends of words: states with equal arcs and finality are one, so that equal right languages are equal states.
    """

    def __init__(self, words: Iterable[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        register: dict[tuple, int] = {}
        # Words in order: what a word doesn't share with the one before it is closed, from its end.
        path: list[tuple[str, dict[str, int], bool]] = []
        root: dict[str, int] = {}
        root_final = False

        def state(arcs: dict[str, int], final: bool) -> int:
            key = (final, *sorted(arcs.items()))
            if key not in register:
                register[key] = len(self.arcs)
                self.arcs.append(arcs)
                self.final.append(final)
            return register[key]

        def close(depth: int) -> None:
            while len(path) > depth:
                label, arcs, final = path.pop()
                above = path[-1][1] if path else root
                above[label] = state(arcs, final)

        before = ""
        for word in sorted(set(words)):
            shared = 0
            while shared < len(before) and shared < len(word) and before[shared] == word[shared]:
                shared += 1
            close(shared)
            if not word:
                root_final = True
            for i in range(shared, len(word)):
                path.append((word[i], {}, i == len(word) - 1))
            before = word
        close(0)
        self.start = state(root, root_final)


class OneEdit:
    """A o T o A for the acceptor of a partition, where T makes one edit as late as it can.

    While nothing is edited both sides stand in the same state. After the edit both read the same rest, which the
    intersection of two right languages holds; those are remembered by pair of states.
    """

    def __init__(self, acceptor: Acceptor):
        self.a = acceptor
        self.rests: dict[tuple[int, int], list[str]] = {}

    def rest(self, p: int, q: int) -> list[str]:
        """What both states accept."""
        waiting = [(p, q)]
        while waiting:
            at = waiting[-1]
            x, y = self.a.arcs[at[0]], self.a.arcs[at[1]]
            missing = [] if at in self.rests else [(x[c], y[c]) for c in x if c in y and (x[c], y[c]) not in self.rests]
            if missing:
                waiting += missing
                continue
            waiting.pop()
            if at not in self.rests:
                ends = [""] if self.a.final[at[0]] and self.a.final[at[1]] else []
                self.rests[at] = ends + [c + r for c in x if c in y for r in self.rests[x[c], y[c]]]
        return self.rests[p, q]

    def pairs(self) -> Iterator[tuple[str, str]]:
        """Accepted pairs (left, right): of equal length with left < right, or right longer by one."""
        stack = [("", self.a.start)]
        while stack:
            done, state = stack.pop()
            arcs = sorted(self.a.arcs[state].items())
            stack += [(done + c, to) for c, to in arcs]
            for i, (c, to) in enumerate(arcs):
                for d, other in arcs[i + 1 :]:
                    for rest in self.rest(to, other):
                        yield done + c + rest, done + d + rest
                # c inserted on the right; as late as it can be, so that the left doesn't go on with c.
                for rest in self.rest(state, to):
                    if not rest.startswith(c):
                        yield done + rest, done + c + rest


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word of a partition that has near words there: their number, and the one that occurs most."""
    for groups, group in whole_groups(batches, ["key"]):
        columns = [groups.column(c).to_pylist() for c in ("word", "n", "size", "before", "after")]
        found: dict[str, tuple[int, int, str]] = {}
        ends = [0, *(i for i in range(1, len(group)) if group[i] != group[i - 1]), len(group)]
        for first, last in zip(ends, ends[1:]):
            if last - first < 2:
                continue
            size, before, after = (columns[i][first] for i in (2, 3, 4))
            inner = {w[before : len(w) - after]: (w, n) for w, n in zip(columns[0][first:last], columns[1][first:last])}
            window = size - before - after
            if not any(len(x) == window for x in inner):
                continue
            here: list[tuple[str, int, str, int]] = []
            for x, y in OneEdit(Acceptor(inner)).pairs():
                # Equal lengths count among the short words only; an insertion at the window's end belongs to the next window.
                if len(x) != window or (after and x == y[:-1]):
                    continue
                here.append((*inner[x], *inner[y]))
            for a, n, b, m in here:
                for word, other, times in ((a, b, m), (b, a, n)):
                    count, most, best = found.get(word, (0, 0, ""))
                    if (-times, other) < (-most, best) or not count:
                        most, best = times, other
                    found[word] = (count + 1, most, best)
        if found:
            count, most, best = zip(*found.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(count, pa.int64()), pa.array(most, pa.int64()), pa.array(best, pa.string())],
                ["word", "n_near", "best_n", "best"],
            )


def _windows(size: Column, before: Column, after: Column) -> list[tuple[Column, Column]]:
    """(before, after) of the two halves of a window."""
    half = F.floor((size - before - after) / 2).cast("int")
    return [(before + half, after), (before, size - before - half)]


def _halved(members: DataFrame) -> DataFrame:
    """Each member in both halves of its window. A window's key is what stands around it, exactly."""
    halves = [F.struct(b.alias("before"), a.alias("after")) for b, a in _windows(F.col("size"), F.col("before"), F.col("after"))]
    cut = members.select("word", "n", "size", F.explode(F.array(*halves)).alias("w")).select("word", "n", "size", "w.before", "w.after")
    around = F.expr("concat_ws('.', size, before, substr(word, 1, before), substr(word, length(word) - after + 1))")
    return cut.where("size - before - after > 0").withColumn("key", around)


def near_words(vocabulary: DataFrame, most: int = MOST) -> DataFrame:
    """word, n_near, best_n, best for each of the distinct words (word, n), of two code points or more, that has near words:
    their number, and the one with the largest n (ties: the smallest)."""
    length = F.length("word")
    # A word meets those of its length, and as the longer one those that are shorter by one.
    sizes = F.explode(F.array(length, length - 1)).alias("size")
    start = vocabulary.select("word", "n", sizes).where("size > 0").withColumns({"before": F.lit(0), "after": F.lit(0)})
    members, done = cut_lineage(_halved(start)), None
    while True:
        counts = members.groupBy("key").agg(F.count("*").alias("members"), F.first("size").alias("s"), F.first("before").alias("b"), F.first("after").alias("a"))
        window = F.col("s") - F.col("b") - F.col("a")
        large = counts.where((window > 1) & ((F.col("members") > most) | ((F.col("members") > 1) & (window > WIDEST))))
        large = cut_lineage(large.select("key"))
        if large.isEmpty():
            break
        small = members.join(spread(large), "key", "left_anti").select(*members.columns)
        done = small if done is None else done.unionByName(small)
        members = cut_lineage(_halved(members.join(spread(large), "key", "left_semi")))
    whole = members if done is None else done.unionByName(members)
    found = gathered(whole, "key").mapInArrow(_near, "word string, n_near long, best_n long, best string")
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.max("best_n").alias("best_n"),
        F.min_by("best", F.struct(-F.col("best_n"), F.col("best"))).alias("best"),
    )


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n: the distinct words of SHORTEST code points or more that occur RAREST times or more."""
    counted = id_and_text(docs, doc_id, text).mapInArrow(_counted, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= RAREST)


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word that (word, form) leads to. A form occurs RATIO times as often, so that paths are short and end."""
    paths = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = spread(paths.select(F.col("word").alias("root"), F.col("root").alias("next")))
        longer = cut_lineage(paths.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")))
        paths = longer.select("word", "root")
        if longer.where("on").isEmpty():
            return paths


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n for each word of the vocabulary of `docs`.

    Words are the maximal runs of ASCII letters and U+00C0 to U+00FF, A-Z lower-cased, one in SLIP of them (by hash of the
    doc_id and the run) without one code point; those of SHORTEST code points that occur RAREST times. Near words differ in
    one inserted, deleted or replaced code point. form is the near word with the largest n (ties: the smallest in
    code-point order) if that is RATIO times the word's own, else null; root is where forms lead. Null and empty texts
    hold no words, a null doc_id hashes as empty, repeated rows count each time, no documents give no rows.
    """
    words = cut_lineage(vocabulary(docs, doc_id, text))
    near = near_words(words)
    joined = words.join(near, "word", "left")
    often = F.col("best_n") >= RATIO * F.col("n")
    named = cut_lineage(
        joined.select(
            "word", F.when(often, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(often, F.col("best_n")).alias("form_n"),
        )
    )
    found = named.join(roots(named.where("form IS NOT NULL")), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"))
