"""License scan: ordered signature rules over the words of a text, from DataFrame functions only.

A rule is a regular expression over lower-cased words. A keyword gates each rule, so that its expression runs on few
texts. Detections may overlap: one that lies within another of higher priority (of equal priority: a longer one, or one
of an earlier rule) is suppressed.
"""

from __future__ import annotations

from collections import Counter
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe.llm.common import ascii_lower, id_and_text, table
from hazeframe.llm.license_rules import BASE, RULES, Rule

#: Detections swept at a time.
BLOCK = 256
#: What isn't part of a word: ASCII other than letters and digits.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def plain_words(text: Column) -> Column:
    """The words as they stand, with one space between two."""
    return F.trim(F.regexp_replace(text, BETWEEN, " "))


def words_line(words: Column) -> Column:
    """Plain words, lower-cased, each between spaces of its own, so that neighbours share none: " a  b  c "."""
    line = F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" "))
    return F.when(words == "", F.lit("")).otherwise(ascii_lower(line))


def count_words(words: Column) -> Column:
    return F.when(words == "", F.lit(0).cast("long")).otherwise(spaces(words) + 1)


def anchors(keywords: set[str]) -> list[str]:
    """Few words of which each keyword holds one: first of all those that many keywords share."""
    left, chosen = set(keywords), []
    while left:
        shared = Counter(w for k in left for w in set(k.split(" ")))
        best = max(shared, key=lambda w: (shared[w], len(w), w))
        chosen.append(best)
        left = {k for k in left if best not in k}
    return chosen


def spaces(text: Column) -> Column:
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def compiled(pattern: str) -> str:
    """A rule's expression over a words line: each space of it stands between two words, " ?" where a break may stand."""
    return " (?:" + pattern.replace(" ?", "(?: )?").replace(" ", "  ") + ") "


def places(line: Column, pattern: Column) -> Column:
    """Where `pattern` stands in a words line: array of struct(first, last) of word numbers, in order.

    A mark goes before each match as a word of its own; its number among the words, less the marks before it, is the
    number of the match's first word.
    """
    marked = F.regexp_replace(line, pattern, F.lit(" \x01 $0"))
    numbered = F.transform(F.split(F.trim(marked), "  "), lambda word, i: F.when(word == "\x01", i))
    marks = F.filter(numbered, F.isnotnull)
    sizes = F.transform(F.regexp_extract_all(line, pattern, F.lit(0)), lambda hit: spaces(hit) / 2)
    pairs = F.arrays_zip(marks.alias("mark"), sizes.alias("size"))
    return F.transform(
        pairs,
        lambda x, j: F.struct(
            (x["mark"] - j).cast("long").alias("first"), (x["mark"] - j + x["size"] - 1).cast("long").alias("last")
        ),
    )


def _rule_table(rules: tuple[Rule, ...]) -> Column:
    """The rules as an array literal, by keyword."""
    ordered = sorted(enumerate(rules), key=lambda item: (item[1].keyword, item[0]))
    gates = []
    for keyword, members in groupby(ordered, key=lambda item: item[1].keyword):
        own = [
            F.struct(
                F.lit(i).alias("rule"), F.lit(compiled(r.pattern)).alias("pattern"), F.lit(r.label).alias("label"),
                F.lit(r.priority).alias("priority"), F.lit(r.weight).alias("weight"),
            )
            for i, r in members
        ]
        gates.append(F.struct(F.lit(keyword.replace(" ", "  ")).alias("keyword"), F.array(*own).alias("rules")))
    return F.array(*gates)


def detections(line: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All detections, in the order of the sweep: first word, then the longer, the stronger, the earlier rule."""
    gates = F.filter(_rule_table(rules), lambda gate: F.contains(line, gate["keyword"]))
    open_rules = F.filter(F.flatten(F.transform(gates, lambda gate: gate["rules"])), lambda r: F.regexp_like(line, r["pattern"]))
    hits = F.flatten(
        F.transform(
            open_rules,
            lambda r: F.transform(
                places(line, r["pattern"]),
                lambda span: F.struct(
                    span["first"].alias("first"), (-span["last"]).alias("minus_last"), (-r["priority"]).alias("minus_priority"),
                    r["rule"].alias("rule"), r["label"].alias("label"), r["weight"].alias("weight"),
                ),
            ),
        )
    )
    return F.array_sort(hits)


def standing(hits: Column, levels: tuple[int, ...]) -> Column:
    """The detections that none suppresses. One sweep: what began earlier, or is longer from the same word, contains a
    later one if it ends no sooner, so the furthest end seen so far at each priority decides. The sweep goes by blocks,
    as each appending copies a list."""
    known = F.array(*(F.lit(level) for level in levels))
    ends = F.array(*(F.lit(-1).cast("long") for _ in levels))
    none = F.slice(hits, 1, 0)

    def step(state: Column, hit: Column) -> Column:
        last, priority = -hit["minus_last"], -hit["minus_priority"]
        over = F.exists(F.arrays_zip(state["ends"].alias("e"), known.alias("p")), lambda x: (x["p"] >= priority) & (x["e"] >= last))
        grown = F.zip_with(state["ends"], known, lambda e, p: F.when(p == priority, F.greatest(e, last)).otherwise(e))
        return F.struct(grown.alias("ends"), F.when(over, state["kept"]).otherwise(F.concat(state["kept"], F.array(hit))).alias("kept"))

    def block(state: Column, start: Column) -> Column:
        own = F.aggregate(F.slice(hits, start, F.lit(BLOCK)), F.struct(state["ends"].alias("ends"), none.alias("kept")), step)
        return F.struct(own["ends"].alias("ends"), F.concat(state["kept"], F.array(own["kept"])).alias("kept"))

    starts = F.sequence(F.lit(1), F.greatest(F.size(hits), F.lit(1)), F.lit(BLOCK))
    first = F.struct(ends.alias("ends"), F.slice(F.array(none), 1, 0).alias("kept"))
    return F.flatten(F.aggregate(starts, first, block, lambda state: state["kept"]))


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections for each row of `docs`.

    Base phrases (license_rules.BASE) count at each place, whatever the rules say. detections are the rules' standing
    ones: struct(first, last, label, weight), words from 0. labels joins both kinds; score is the greatest weight of what
    was found, 0 without. A null or empty text has no words: counts 0, word numbers null, labels empty. Repeated rows
    give repeated rows. The largest thing held is one text with its words.
    """
    levels = tuple(sorted({r.priority for r in rules}))
    phrases = "|".join(BASE)
    given = id_and_text(docs, doc_id, text).select("doc_id", plain_words(F.col("text")).alias("words"))
    # lower() changes more than A-Z, but keeps every ASCII keyword that lower-casing A-Z brings out.
    words = F.array(*(F.lit(w) for w in anchors({r.keyword for r in rules} | set(BASE))))
    gate = F.transform(F.array(F.lower("words")), lambda low: F.exists(words, lambda w: F.contains(low, w)))[0]
    gated = F.when(gate, words_line(F.col("words"))).otherwise(F.lit(""))
    found = given.select("doc_id", count_words(F.col("words")).alias("n_words"), gated.alias("line"))
    # Texts without any keyword end here: their line is empty, and each step below sees an empty array.
    found = found.withColumn("base", places(F.col("line"), F.lit(compiled(phrases))))
    found = found.withColumn("phrases", F.regexp_extract_all("line", F.lit(compiled(phrases)), F.lit(0)))
    found = found.withColumn("hits", detections(F.col("line"), rules))
    found = found.withColumn("kept", standing(F.col("hits"), levels))
    names = F.create_map(*(F.lit(x) for p, label in BASE.items() for x in (compiled_text(p), label)))
    base_labels = F.array_distinct(F.transform("phrases", lambda p: names[p]))
    by_rule = F.transform("kept", lambda h: h["label"])
    weights = F.concat(F.transform("kept", lambda h: h["weight"]), F.transform("base", lambda _: F.lit(BASE_WEIGHT)))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.when(F.size("base") > 0, F.col("base")[0]["first"]).alias("first_word"),
        F.when(F.size("base") > 0, F.element_at("base", -1)["first"]).alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, by_rule))), ",").alias("labels"),
        F.coalesce(F.array_max(weights), F.lit(0.0)).alias("score"),
        F.transform("kept", lambda h: F.struct(h["first"].alias("first"), (-h["minus_last"]).alias("last"), h["label"].alias("label"), h["weight"].alias("weight"))).alias("detections"),
    )


#: A base phrase alone is a mention, seldom a grant.
BASE_WEIGHT = 0.5


def compiled_text(phrase: str) -> str:
    """A plain phrase as it stands in a words line."""
    return " " + phrase.replace(" ", "  ") + " "


def op1(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents")).drop("detections")


def _oracle() -> str:
    """The same in DuckDB: rules as a table, positions from the pieces between matches, suppression by comparing pairs."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rules = ",\n  ".join(
        f"({i}, {quote(r.keyword.replace(' ', '  '))}, {quote(compiled(r.pattern))}, {quote(r.label)}, {r.priority}, CAST({r.weight} AS DOUBLE))"
        for i, r in enumerate(RULES)
    )
    phrases = quote(compiled("|".join(BASE)))
    names = ", ".join(f"{quote(compiled_text(p))}: {quote(label)}" for p, label in BASE.items())
    spaces_in = lambda x: f"(length({x}) - length(replace({x}, ' ', ''))) // 2"
    firsts = lambda p: (
        f"list_transform(regexp_extract_all(line, {p}), lambda x, i: list_sum(list_transform(string_split_regex(line, {p})[:i], lambda g: {spaces_in('g')}))"
        f" + coalesce(list_sum(list_transform(regexp_extract_all(line, {p})[:i - 1], lambda h: {spaces_in('h')})), 0))"
    )
    return rf"""
WITH rules(rule, keyword, pattern, label, priority, weight) AS (VALUES
  {rules}),
lined AS (
  SELECT doc_id, row_number() OVER () AS n, CASE WHEN inner_text = '' THEN '' ELSE ' ' || replace(inner_text, ' ', '  ') || ' ' END AS line
  FROM (SELECT doc_id, trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' ') AS inner_text FROM documents)),
based AS (
  SELECT doc_id, n, line, {spaces_in("line")} AS n_words, {firsts(phrases)} AS places,
    list_transform(regexp_extract_all(line, {phrases}), lambda x: MAP {{{names}}}[x]) AS base
  FROM lined),
found AS (
  SELECT n, rule, label, priority, weight, unnest({firsts("pattern")}) AS first, unnest(list_transform(regexp_extract_all(line, pattern), lambda h: {spaces_in("h")})) AS size
  FROM lined JOIN rules ON contains(line, keyword) AND regexp_matches(line, pattern)),
kept AS (
  SELECT n, list(DISTINCT label) AS labels, max(weight) AS weight FROM found f
  WHERE NOT EXISTS (SELECT 1 FROM found g WHERE g.n = f.n AND g.first <= f.first AND g.first + g.size >= f.first + f.size AND g.priority >= f.priority
    AND (g.priority > f.priority AND (g.first < f.first OR g.size > f.size OR g.first = f.first) OR g.priority = f.priority
      AND (g.first < f.first OR g.size > f.size OR g.size = f.size AND g.rule < f.rule)))
  GROUP BY n)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(base) AS BIGINT) AS n_base, CAST(places[1] AS BIGINT) AS first_word, CAST(places[-1] AS BIGINT) AS last_word,
  array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base, coalesce(labels, [])))), ',') AS labels,
  greatest(coalesce(weight, 0.0::DOUBLE), CASE WHEN len(base) > 0 THEN {BASE_WEIGHT}::DOUBLE ELSE 0.0::DOUBLE END) AS score
FROM based LEFT JOIN kept USING (n)
"""


ORACLE = _oracle()
