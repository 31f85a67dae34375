"""Packing documents into token sequences of one length, in their order.

Where the sequences end is a shortest path over the tokens of a run of documents: each sequence costs its padding, each
cut inside a document a penalty, less at a sentence's end. The cheapest start of a sequence that ends at a given place
is the minimum over a window that only moves forward, which a monotone queue yields in constant time a place.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Iterator
from functools import partial

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from hazeframe.llm.common import id_and_text, slices, table

VOCABULARY = "byte_bpe_50k.json"
WINDOW = 1024
#: What a cut costs, in tokens of padding: after a sentence, and elsewhere inside a document. After a document: nothing.
SENTENCE_CUT, OTHER_CUT = 1, 4
#: What a sequence costs besides, so that short ones of a length that needs no padding are taken only where they help.
SEQUENCE = 32
#: Tokens that are packed as one run, in which the cuts are optimal; the documents of a task make as many runs as needed.
RUN = 1 << 20


def byte_of() -> dict[str, int]:
    """The bytes for which the characters of a byte-level vocabulary stand: printable ones for themselves, the others,
    in order, for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of a byte-level tokenizer file, as its own library gives them, from the faster engine of tiktoken.

    Both merge alike where the merges of the file stand in the order of their ids, which is checked.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        vocabulary, letters = described["model"]["vocab"], byte_of()
        special = {t["content"]: t["id"] for t in described["added_tokens"]}
        merges = [m if isinstance(m, str) else " ".join(m) for m in described["model"]["merges"]]
        made = [vocabulary[m.replace(" ", "")] for m in merges]
        if made != sorted(made) or described["pre_tokenizer"]["type"] != "ByteLevel" or described["normalizer"]:
            raise ValueError(f"{path}: not a byte-level vocabulary whose merges stand in the order of their ids")
        ranks = {bytes(letters[c] for c in word): i for word, i in vocabulary.items() if word not in special}
        self.engine = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        written = [""] * (max([*ranks.values(), *special.values()]) + 1)
        for word, i in ranks.items():
            written[i] = word.decode(errors="replace")
        self.closing = np.array([w.rstrip("\"')]}")[-1:] in (".", "!", "?", "\n") for w in written])
        self.opening = np.array([w[:1].isspace() for w in written])

    def encode(self, text: str) -> np.ndarray:
        return self.engine.encode_to_numpy(text, allowed_special="all")

    def sentence_ends(self, ids: np.ndarray) -> np.ndarray:
        """Numbers of ids after which a sentence ends: at . ! ? or a line's end, before white space."""
        before_space = np.append(self.opening[ids[1:]], False)
        closing = self.closing[ids]
        return np.flatnonzero(closing & before_space) + 1


def cut_places(ends: np.ndarray, sentences: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a sequence may end, ascending, and what cutting there costs.

    `ends` (ascending, the last one is the run's) are ends of documents, `sentences` ends of sentences. Each of them is a
    place, and the place one window after each; gaps wider than a window are filled window by window.
    """
    natural = np.unique(np.concatenate([np.zeros(1, np.int64), ends, sentences]))
    gaps = np.diff(natural)
    wide = np.flatnonzero(gaps > window)
    fill = [np.arange(natural[i] + window, natural[i + 1], window) for i in wide]
    places = np.unique(np.concatenate([natural, natural + window, *fill]))
    places = places[(places > 0) & (places <= ends[-1])]
    cost = np.full(len(places), OTHER_CUT, dtype=np.int64)
    cost[np.isin(places, sentences)] = SENTENCE_CUT
    cost[np.isin(places, ends)] = 0
    return places, cost


def padding(length: int, window: int) -> int:
    """A sequence is padded to the window, unless its length is a power of two."""
    return 0 if length & (length - 1) == 0 else window - length


def best_cuts(places: list[int], cost: list[int], window: int) -> list[int]:
    """The ends of the sequences that together cost least (padding, cuts, SEQUENCE for each); ties go to the longest last sequence.

    With total(k) the least cost of a packing that ends at places[k], a sequence from j to k costs window - (k - j) unless
    its length is a power of two: total(j) + j is all that depends on j, so its minimum over the window is at the head of
    a queue that is kept ascending. The few power-of-two starts are looked up by place.
    """
    total, previous = {0: 0}, {0: -1}
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (total + place, place), both ascending
    powers = [1 << i for i in range(window.bit_length()) if 1 << i <= window]
    for place, extra in zip(places, cost):
        while queue and queue[0][1] < place - window:
            queue.popleft()
        least, start = None, -1
        if queue:
            value, start = queue[0]
            least = value - place + window
        for power in powers:
            before = total.get(place - power)
            if before is not None and (least is None or before < least or before == least and place - power < start):
                least, start = before, place - power
        least += extra + SEQUENCE
        total[place], previous[place] = least, start
        value = least + place
        while queue and queue[-1][0] > value:
            queue.pop()
        queue.append((value, place))
    cuts, at = [], places[-1]
    while at > 0:
        cuts.append(at)
        at = previous[at]
    return cuts[::-1]


def pack_run(lengths: list[int], sentences: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece, all numbers from 0, for documents of these lengths.

    `sentences` are token numbers in the run after which a sentence ends. Lengths are positive.
    """
    ends = np.cumsum(np.asarray(lengths, dtype=np.int64))
    places, cost = cut_places(ends, sentences, window)
    pieces, document, begun, at = [], 0, 0, 0
    bounds = ends.tolist()
    for sequence, cut in enumerate(best_cuts(places.tolist(), cost.tolist(), window)):
        first = at
        while at < cut:
            stop = min(cut, bounds[document])
            pieces.append((document, at - begun, stop - at, sequence, at - first))
            at = stop
            if at == bounds[document]:
                begun, document = at, document + 1
    return pieces


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


FIELDS = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.list_(pa.int32())),
    ]
)


def _packed(batches: Iterator[pa.RecordBatch], name: str, window: int, closing_id: int) -> Iterator[pa.RecordBatch]:
    encode = encoder(public_tokenizers.path(name))
    sequence_base = TaskContext.get().partitionId() << 40
    held: list[tuple[int | None, np.ndarray]] = []
    tokens = 0

    def flush() -> pa.RecordBatch:
        nonlocal sequence_base
        starts = np.cumsum([0, *(len(ids) for _, ids in held)])
        sentences = np.concatenate([encode.sentence_ends(ids) + start for (_, ids), start in zip(held, starts)])
        rows = []
        for number, start, length, sequence, offset in pack_run([len(ids) for _, ids in held], sentences, window):
            doc_id, ids = held[number]
            part = ids[start : start + length]
            rows.append((doc_id, start, length, zlib.crc32(part.tobytes()), len(ids), sequence_base + sequence, offset))
        sequence_base = rows[-1][5] + 1
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), FIELDS)]
        # Pieces follow each other without gaps, so that their ids are those of the run.
        bounds = np.cumsum([0, *(row[2] for row in rows)], dtype=np.int32)
        run = np.concatenate([ids for _, ids in held]).view("<i4")
        columns.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(run)))
        return pa.RecordBatch.from_arrays(columns, schema=FIELDS)

    for batch in slices(batches):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids = np.append(encode.encode(text), np.uint32(closing_id)).astype("<u4")
            held.append((doc_id, ids))
            tokens += len(ids)
            if tokens >= RUN:
                yield flush()
                held, tokens = [], 0
    if held:
        yield flush()


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    vocabulary: str = VOCABULARY,
    window: int = WINDOW,
    closing_id: int = 0,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    A document is its ids and `closing_id`, so that an empty or null text has one id. Documents stand in the order of
    their rows, in sequences of at most `window` ids, gapless; each partition of `docs` is packed by itself, without a
    shuffle, in runs of RUN tokens. Nothing is left out: a text longer than a window goes on in the next one. Repeated
    rows are packed as often as they occur. sequence_id is unique, not dense. A task holds a run and one text.
    """
    rows = id_and_text(docs, doc_id, text)
    return rows.mapInArrow(
        partial(_packed, name=vocabulary, window=window, closing_id=closing_id),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>",
    )


def op2(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents")).drop("ids")


def pack_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: the pieces of all documents that are left, with their ids.

    Null and empty texts have one id, repeated rows are packed each time, other columns are left out, and an empty table
    gives no pieces.
    """
    return pack(docs)
