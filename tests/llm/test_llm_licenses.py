"""License scan: words, base phrases, rules and their suppression."""

import re

from hazeframe.llm import licenses
from hazeframe.llm.license_rules import BASE, RULES

DOCS = "doc_id long, text string"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def scan(spark, texts):
    rows = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()
    return {r.doc_id: r for r in rows}


def test_hundreds_of_rules_whose_keywords_gate_them():
    assert len(RULES) > 200
    for rule in RULES:
        re.compile(licenses.compiled(rule.pattern))
        assert "," not in rule.label


def test_base_by_brute_force(spark):
    texts = [
        "", None, "MIT License", "the mit\tlicense; mit-license mit  licenses", "cc by cc by-sa", "GNU General Public\nLicense é license",
        "apache license " * 300, "cc", "Kmit license", "été mit license", "1 2 3", "x" * 50_000 + " mit license",
    ]
    found = scan(spark, texts)
    for i, text in enumerate(texts):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = WORDS.findall(low)
        places, labels = [], set()
        for phrase, label in BASE.items():
            parts = phrase.split()
            at = [k for k in range(len(words)) if words[k : k + len(parts)] == parts]
            places += at
            labels |= {label} if at else set()
        row = found[i]
        assert (row.n_words, row.n_base) == (len(words), len(places)), text
        assert (row.first_word, row.last_word) == (min(places, default=None), max(places, default=None))
        assert row.base_labels == ",".join(sorted(labels)) and set(labels) <= set(row.labels.split(",")) | {""}
        assert 0 <= row.score <= 1


def test_contained_detections_of_less_priority_are_suppressed(spark):
    texts = ["Licensed under the Apache License, Version 2.0", "SPDX-License-Identifier: GPL-2.0-only", "cc by-nc-sa", "license: isc and gnu gpl"]
    found = scan(spark, texts)
    assert [(d.first, d.last, d.label) for d in found[0].detections] == [(0, 7, "apache-2.0")]
    assert found[0].labels == "apache,apache-2.0" and found[0].score == 0.9
    assert found[1].labels == "gpl-2"
    assert found[2].labels == "cc-by-nc-sa" or "cc-by-nc-sa" in found[2].labels
    assert found[3].labels == "gpl,isc"


def test_long_text_with_many_detections(spark):
    row = scan(spark, ["MIT LICENSE " * 5_000])[0]
    assert (row.n_words, row.n_base, row.first_word, row.last_word, row.labels) == (10_000, 5_000, 0, 9_998, "mit")


def test_no_rows(spark):
    assert licenses.scan_licenses(spark.createDataFrame([], DOCS)).count() == 0


def test_word_breaks_that_may_be_missing(spark):
    labels = {
        "Creative Commons Attribution-ShareAlike 4.0 International": "cc-by-sa",
        "Creative Commons Attribution Share Alike 4.0": "cc-by-sa",
        "Creative Commons Attribution-NonCommercial 4.0": "cc-by-nc",
        "Creative Commons Attribution-NoDerivatives 4.0": "cc-by-nd",
        "Creative Commons Attribution-NoDerivs 3.0": "cc-by-nd",
        "Creative Commons Attribution-NonCommercial-ShareAlike 4.0": "cc-by-nc-sa",
        "Creative Commons Attribution-Non-Commercial-No-Derivatives 4.0": "cc-by-nc-nd",
        "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0": "cc-by-nc-nd",
        "for noncommercial use only": "non-commercial",
        "for non-commercial purposes only": "non-commercial",
    }
    found = scan(spark, list(labels))
    assert [found[i].labels for i in range(len(labels))] == list(labels.values())
    texts = ["GNU Affero General Public License", "the GNU Affero General Public License v3", "GNU Affero General Public License, version 3 only"]
    assert ["agpl-3" in row.labels.split(",") for row in scan(spark, texts).values()] == [True] * 3
