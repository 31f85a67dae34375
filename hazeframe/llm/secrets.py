"""Secrets in texts: plain patterns, and values in a credential's place that withstand guessing.

Whether a value is a secret or a placeholder ("password = changeme1") is decided by the guesses it takes, found by dynamic
programming over its cheapest segmentation (`guesses`).
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazeframe.llm.common import cut_lineage, id_and_text, slices, table
from hazeframe.llm.guesses import Guesser

#: Fixed patterns; their letters stand for either case where (?i) says so, ASCII only. The whole match is the span.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: Least lengths: of group 2, and of whole matches.
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
#: Kinds in the order in which they stand for spans that begin together; "guess" is the method's.
KINDS = ("assign", "access", "hex", "guess")
#: A name, its sign, and a value, with an authentication scheme before it or without. A name begins where no longer one does, and
#: no repetition is taken back, so that a text is gone through once whatever it holds.
NAMED = re.compile(
    r"""(?i)(?<![\w.-])(?P<name>[\w.-]++)["'`]?\s*+(?:=>|:=|[:=])\s*+(?:["'`]?(?P<scheme>bearer|basic|token|digest)\s++)?+"""
    r"""(?:["'`](?P<quoted>[^"'`\s]{6,}+)["'`]|(?P<plain>[^\s"'`<>;,]{6,}+))"""
)
#: A name is a credential's if one of these ends it, or ends before a sign within it.
CREDENTIAL = re.compile(
    r"(?i)(?:password|passwd|passphrase|passcode|passwort|contraseña|pwd|secret|token|bearer|api[_-]?key|access[_-]?key|private[_-]?key|auth(?:orization)?|credentials?)(?=\Z|[_.-])"
)
#: Schemes that name themselves before a value, and addresses that hold a user's password.
BARE = re.compile(r"""(?ai)\b(?P<bare>bearer|basic)\s++["'`]?(?P<alone>[a-z0-9._~+/=-]{6,}+)""")
ADDRESS = re.compile(r"""(?ai)(?<=[a-z0-9+.-])://[^\s:/@"'<>]++:(?P<inside>[^\s/@"'<>]{6,}+)@""")
#: One of these stands in whatever NAMED finds of a credential, in lower case.
NEEDED = ("passw", "passph", "passc", "contrase", "pwd", "secret", "token", "bearer", "key", "auth", "credential")
#: Guesses (log10) from which a value in a credential's place counts as a secret.
LEAST_GUESSES = 10.0
#: Words of the corpus that guesses may use, at most, the commonest first, and in how many texts a word must stand.
LEARNED, LEAST_TEXTS = 20_000, 5
#: Words that a task counts before it sends them on.
HELD = 200_000
_WORD = re.compile(r"\b[A-Za-zÀ-ÖØ-öø-ÿ][a-zß-öø-ÿ]{2,19}\b")

Span = tuple[int, int, int]


def base_spans(text: str, low: str) -> list[Span]:
    """(start, kind, end) of the fixed patterns: leftmost, without overlap within a kind, less those that are too short."""
    found = []
    if "pass" in low or "secret" in low or "token" in low or "key" in low:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return found


#: The same matches as HEX has of that length: a match of HEX is a run as long as can be.
LONG_HEX = re.compile(f"[0-9a-f]{{{LEAST_HEX},}}")


#: What a bearer's token has and a word of prose hasn't: a digit, or a capital after a small letter.
TOKEN = re.compile("[0-9]|[a-z][A-Z]")


def credential(scheme: str, value: str) -> bool:
    """Whether `value`, after white space alone, belongs to the scheme ("basic training" doesn't): for basic, base64 of a
    name and a password with a colon between (RFC 7617)."""
    if scheme.lower() == "bearer":
        return TOKEN.search(value) is not None
    try:
        name, colon, _ = base64.b64decode(value + "=" * (-len(value) % 4), validate=True).partition(b":")
        return colon != b"" and name != b"" and name.decode().isprintable()
    except ValueError:
        return False


def _credentials(text: str, low: str) -> Iterator[tuple[int, str]]:
    """(start, value) of what stands in a credential's place, without closing punctuation."""
    if any(word in low for word in NEEDED):
        at = 0
        while match := NAMED.search(text, at):
            group = match.lastgroup
            at = match.end()
            if CREDENTIAL.search(match["name"]):
                value = match[group].rstrip(".)]}!?")
                yield match.start(group), value
            if match["scheme"] or not CREDENTIAL.search(match["name"]):
                at = match.start(group)  # what stands there may be a name itself
    if "bearer" in low or "basic" in low:
        for match in BARE.finditer(text):
            value = match["alone"].rstrip(".)]}!?")
            if credential(match["bare"], value):
                yield match.start("alone"), value
    if "://" in text:
        for match in ADDRESS.finditer(text):
            yield match.start("inside"), match["inside"].rstrip(".)]}!?")


def guessed_spans(text: str, low: str, guesser: Guesser, least: float = LEAST_GUESSES) -> list[Span]:
    """(start, kind, end) of values in a credential's place whose cheapest segmentation takes 10**least guesses or more.

    The span is the value's. A common word takes few guesses; so do dates, keyboard walks and repeats. Of values that
    overlap the first counts.
    """
    found: list[Span] = []
    for start, value in sorted(set(_credentials(text, low)), key=lambda v: (v[0], -len(v[1]))):
        if len(value) >= 6 and not (found and start < found[-1][2]) and guesser.log_guesses(value) >= least:
            found.append((start, 3, start + len(value)))
    return found


#: Guesses by the short list of words alone.
PLAIN = Guesser()


def all_spans(text: str, guesser: Guesser = PLAIN, least: float = LEAST_GUESSES) -> list[Span]:
    low = text.lower()
    return sorted(base_spans(text, low) + guessed_spans(text, low, guesser, least))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and the number of a task's texts that they stand in."""
    seen: Counter[str] = Counter()

    def flushed() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
        seen.clear()
        return batch

    for batch in slices(batches):
        for text in batch.column("text").to_pylist():
            seen.update({w.lower() for w in _WORD.findall(text)})
            if len(seen) >= HELD:
                yield flushed()
    if seen:
        yield flushed()


def learned_words(rows: DataFrame, most: int = LEARNED) -> list[str]:
    """The words that stand in most texts of `rows` (text), the commonest first, ties by the word itself.

    All texts count. Only whole words in small letters or with a first capital are looked at, and a word must stand in LEAST_TEXTS texts,
    so that pieces of random values aren't learned. There are at most `most` words, which go to all tasks; words of the
    number of texts at which there would be more are left out together, so that no task sorts the vocabulary.
    """
    counted = rows.select("text").mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = cut_lineage(counted.where(F.col("n") >= LEAST_TEXTS))
    # As many rows as there are different numbers of texts.
    levels = counted.groupBy("n").agg(F.count("*").alias("words"))
    levels = levels.withColumn("upto", F.sum("words").over(Window.orderBy(F.desc("n"))))
    least = levels.where(F.col("upto") <= most).agg(F.min("n").alias("n")).first().n
    if least is None:
        return []
    return [row.word for row in sorted(counted.where(F.col("n") >= least).collect(), key=lambda row: (-row.n, row.word))]


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _found(batches: Iterator[pa.RecordBatch], words: list[str], least: float) -> Iterator[pa.RecordBatch]:
    guesser = Guesser(words)
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    for batch in slices(batches):
        rows = [all_spans(t, guesser, least) for t in batch.column("text").to_pylist()]
        listed = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans] for spans in rows]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(listed, pa.list_(item))], ["doc_id", "spans"])


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, least: float = LEAST_GUESSES) -> DataFrame:
    """doc_id, spans (array of struct(kind, start, end), code points, end exclusive) for each row.

    Spans stand by start, then by kind in the order of KINDS. Null and empty texts have none; repeated rows are repeated.
    Guesses know the words that are common in `docs` (`learned_words`). An empty table gives no rows.
    """
    rows = id_and_text(docs, doc_id, text)
    return rows.mapInArrow(partial(_found, words=learned_words(rows), least=least), "doc_id long, spans array<struct<kind:string,start:bigint,end:bigint>>")


def secret_digests(found: DataFrame) -> DataFrame:
    """Counts and texts of the spans of `find_secrets`."""
    plain = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in KINDS[:3]),
        F.sha2(F.array_join(F.transform(base, plain), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", plain), ",").alias("spans"),
        count("guess").alias("n_guess"),
    )


def op4(spark: SparkSession, folder: str) -> DataFrame:
    return secret_digests(find_secrets(table(spark, folder, "documents")))


def mask(text: str, guesser: Guesser = PLAIN, least: float = LEAST_GUESSES) -> str:
    """`text` with each secret replaced by its kind in angle brackets; overlapping ones become one, of the first's kind."""
    parts, at = [], 0
    spans = all_spans(text, guesser, least)
    i = 0
    while i < len(spans):
        start, kind, end = spans[i]
        while i + 1 < len(spans) and spans[i + 1][0] < end:
            i += 1
            end = max(end, spans[i][2])
        parts += [text[at:start], f"<{KINDS[kind]}>"]
        at, i = end, i + 1
    return "".join([*parts, text[at:]])


def _masked(batches: Iterator[pa.RecordBatch], columns: list[str], words: list[str]) -> Iterator[pa.RecordBatch]:
    guesser = Guesser(words)
    for batch in slices(batches):
        texts = [None if t is None else mask(t, guesser) for t in batch.column("text").to_pylist()]
        arrays = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in columns]
        if "n_chars" in columns:
            counts = [n if t is None else len(t) for t, n in zip(texts, batch.column("n_chars").to_pylist())]
            arrays[columns.index("n_chars")] = pa.array(counts, batch.schema.field("n_chars").type)
        yield pa.RecordBatch.from_arrays(arrays, columns)


def mask_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: every document stays, with its secrets masked and n_chars counted anew.

    Null texts stay null, empty ones empty; repeated rows are masked alike; further columns stay as they are, and an empty
    table stays empty.
    """
    words = learned_words(id_and_text(docs))
    return docs.mapInArrow(partial(_masked, columns=docs.columns, words=words), docs.schema)


def digest_of(spans: list[Span]) -> str:
    return hashlib.sha256(written([s for s in spans if s[1] < 3]).encode()).hexdigest()
