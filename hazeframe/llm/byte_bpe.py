"""Byte-level BPE in linear time, and its inverse.

Merging by rank is replaced by a search for the one segmentation whose neighbours are all compatible: two tokens are if
merging their joined bytes gives the two again. From each position the longest token is tried first, found by an
Aho-Corasick automaton over the bytes as Latin-1 text; a dead end steps back to a shorter token, and positions known to be
dead ends aren't tried twice. Whether two tokens are compatible is seen from the parts that stand at their border while
merges are made, without making them; it is remembered by pair, results by stretch of text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import partial
from itertools import chain

import ahocorasick
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from hazeframe.llm.common import id_and_text, slices, table
from hazeframe.llm.stretches import Remembered, part_of

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pairs of tokens that a worker remembers before it begins anew; stretches of text and words that it remembers at least.
PAIRS, STRETCHES, WORDS = 2_000_000, 250_000, 150_000


class ByteBpe:
    """Encoder and decoder of a rank file: lines of base64 bytes and rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        self.ranks = ranks
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            self.pieces[rank] = piece
        self.split = regex.compile(pattern).findall
        self.usual = pattern == public_tokenizers.PATTERN
        self.automaton = ahocorasick.Automaton()
        # What the last merge of each token joins; none for single bytes.
        self.halves: list[tuple[int, int] | None] = [None] * len(self.pieces)
        for piece, rank in ranks.items():
            # A token that merging its own bytes never yields can stand only for a whole word, as `word` does.
            if len(piece) > 1:
                halves = self.merged(piece, 2)
                if len(halves) > 2 or self.pieces[halves[0]] + self.pieces[halves[1]] != piece:
                    continue
                self.halves[rank] = halves[0], halves[1]
            self.automaton.add_word(piece.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.sizes = [len(piece) for piece in self.pieces]
        # For each token, the longest token that is a proper prefix of it; -1 for single bytes.
        self.shorter = [-1] * len(self.pieces)
        for piece, rank in ranks.items():
            for size in range(len(piece) - 1, 0, -1):
                if self.automaton.exists(piece[:size].decode("latin-1")):
                    self.shorter[rank] = ranks[piece[:size]]
                    break
        self.compatible: dict[tuple[int, int], bool] = {}
        self.ends: dict[tuple[int, int], list[int]] = {}
        self.stretches = Remembered(self.keyed, STRETCHES)
        self.words = Remembered(lambda word: tuple(self.word(word.encode())), WORDS)

    @classmethod
    def load(cls, path: str) -> ByteBpe:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)})

    def merged(self, data: bytes, least: int = 1) -> list[int]:
        """The definition: of neighbouring parts, join the pair of lowest rank, the leftmost first, until none has one, or
        until `least` parts are left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > least:
            ranked = [(self.ranks.get(a + b, len(self.pieces)), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, i = min(ranked)
            if rank == len(self.pieces):
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def end_parts(self, token: int, side: int) -> list[int]:
        """The parts that stand first (side 0) or last (side 1) in a token while it is merged, from a byte to the whole."""
        known = self.ends.get((token, side))
        if known is None:
            known, part = [token], token
            while self.halves[part]:
                part = self.halves[part][side]
                known.append(part)
            known.reverse()
            self.ends[token, side] = known
        return known

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the joined bytes of two tokens gives the two.

        Of the merges that touch the border, the next in either token comes at the rank of what it makes. One over the border
        comes first if its rank is below the left one's and not above the right one's: equal ranks go from left to right.
        """
        known = self.compatible.get((left, right))
        if known is not None:
            return known
        if len(self.compatible) >= PAIRS:
            self.compatible.clear()
        last, first = self.end_parts(left, 1), self.end_parts(right, 0)
        pieces, never = self.pieces, len(self.pieces)
        i = j = 0
        known = True
        while True:
            over = self.ranks.get(pieces[last[i]] + pieces[first[j]], never)
            next_left = last[i + 1] if i + 1 < len(last) else never
            next_right = first[j + 1] if j + 1 < len(first) else never
            if over < next_left and over <= next_right and over < never:
                known = False
                break
            if next_left == next_right == never:
                break
            if next_left <= next_right:
                i += 1
            else:
                j += 1
        self.compatible[left, right] = known
        return known

    def word(self, data: bytes) -> list[int]:
        """The ids of one match of the pattern."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        text, size, sizes, shorter = data.decode("latin-1"), len(data), self.sizes, self.shorter
        known, fits = self.compatible.get, self.fits
        # Often the longest token at each place fits the one before it.
        ids: list[int] = []
        left, place, steps = -1, 0, self.automaton.iter_long(text)
        for end, token in steps:
            if left >= 0 and not (fits(left, token) if (fit := known((left, token))) is None else fit):
                break
            ids.append(token)
            left, place = token, end + 1
        else:
            return ids
        # The longest token at each place that greedy steps reach; other places are looked up when they are met.
        longest, at = {place: token}, end + 1
        for end, later in steps:
            longest[at] = later
            at = end + 1
        at = 0
        for earlier in ids:
            longest[at] = earlier
            at += sizes[earlier]
        dead, token = bytearray(size + 1), shorter[token]
        while True:
            while token < 0:  # a dead end: the token before it must be shorter
                dead[place] = 1
                token = ids.pop()
                place -= sizes[token]
                token = shorter[token]
            end = place + sizes[token]
            if dead[end] or ids and not (fits(ids[-1], token) if (fit := known((ids[-1], token))) is None else fit):
                token = shorter[token]
                continue
            ids.append(token)
            if end == size:
                return ids
            place = end
            token = longest.get(place)
            if token is None:
                token = longest[place] = next(self.automaton.iter_long(text, place))[1]

    def keyed(self, key: str) -> tuple[int, ...]:
        """The ids of the stretch of a key."""
        if self.usual and key.isascii() and key.isalpha():  # a space and letters: one match of the pattern
            return tuple(self.word(b" " + key.encode()))
        return self.stretch(part_of(key))

    def stretch(self, text: str) -> tuple[int, ...]:
        words = self.split(text)
        if len(words) == 1:
            return tuple(self.word(text.encode()))
        return tuple(chain.from_iterable(map(self.words.__getitem__, words)))

    def encode(self, text: str) -> list[int]:
        """The ids of a text; time in proportion to its length."""
        return list(chain.from_iterable(self.stretches.of(text)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


_loaded: dict[str, ByteBpe] = {}


def encoder(path: str) -> ByteBpe:
    """One encoder for each file in a worker process."""
    if path not in _loaded:
        _loaded[path] = ByteBpe.load(path)
    return _loaded[path]


def _encoded(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    bpe = encoder(public_tokenizers.path(name))
    for batch in slices(batches):
        ids = [bpe.encode(t) for t in batch.column("text").to_pylist()]
        decoded = [bpe.decode(i) for i in ids]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"]
        )


def encode_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, ids, decoded (the bytes of the ids) for each row. Null text counts as empty: no ids."""
    return id_and_text(docs, doc_id, text).mapInArrow(partial(_encoded, name=vocabulary), "doc_id long, ids array<int>, decoded binary")


def _digests(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    bpe = encoder(public_tokenizers.path(name))
    written = [str(i) for i in range(len(bpe.pieces))]
    for batch in slices(batches):
        counts, hashes, back = [], [], []
        for text in batch.column("text").to_pylist():
            ids = bpe.encode(text)
            counts.append(len(ids))
            hashes.append(hashlib.sha256(",".join(map(written.__getitem__, ids)).encode()).hexdigest())
            back.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(back, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def token_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each row, without sending ids out of the task.

    A null or empty text has no tokens and the digests of nothing; repeated rows give repeated rows; `vocabulary` names
    the rank file. A task holds one text with its ids at a time.
    """
    columns = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return id_and_text(docs, doc_id, text).mapInArrow(partial(_digests, name=vocabulary), columns)


def op8(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(table(spark, folder, "documents"))
