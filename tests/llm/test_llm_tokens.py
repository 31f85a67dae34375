"""Byte-level BPE and packing against the public libraries and brute force."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hazeframe.llm import byte_bpe, packing
from hazeframe.llm.stretches import Remembered, part_of, stretches

PIECES = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "\xa0", "　", "é", "ß", "日本", "🙂", "0", "12", "'s", "'re", "!", "<|endoftext|>", "\x1c", "\x85", "\r\n", "Q", "_", "<|"]
TEXT = st.one_of(st.text(max_size=60), st.lists(st.sampled_from(PIECES), max_size=30).map("".join))
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.encoder(public_tokenizers.path(byte_bpe.VOCABULARY))


@pytest.fixture(scope="module")
def tik(bpe):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_stretches_join_to_the_text(text):
    assert "".join(map(part_of, stretches(text))) == text


def test_results_in_use_are_kept():
    computed = []
    known = Remembered(lambda key: computed.append(key) or key, 3)
    for i in range(40):
        known.of(f"the of w{i}")
        assert len(known.young) <= 3 and len(known.old) <= 3
    assert computed.count("of") == 1 and computed.count("the ") == 1 and len(computed) == 42


def test_neighbours_are_compatible_as_merging_says(bpe):
    random.seed(3)
    tokens = [rank for rank in bpe.ranks.values() if len(bpe.pieces[rank]) == 1 or bpe.halves[rank]]
    short = [t for t in tokens if len(bpe.pieces[t]) <= 3]
    for _ in range(20_000):
        left, right = random.choice(random.choice([tokens, short])), random.choice(random.choice([tokens, short]))
        assert bpe.fits(left, right) == (bpe.merged(bpe.pieces[left] + bpe.pieces[right]) == [left, right])


@settings(max_examples=600, deadline=None)
@given(TEXT)
def test_bpe_equals_the_library(text):
    bpe = byte_bpe.encoder(public_tokenizers.path(byte_bpe.VOCABULARY))
    tik = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    ids = bpe.encode(text)
    assert ids == tik.encode_ordinary(text) and bpe.decode(ids) == text.encode()


def test_bpe_on_the_documents(spark, medium, bpe, tik):
    for row in spark.read.parquet(f"{medium}/documents.parquet").select("text").collect():
        assert bpe.encode(row.text) == tik.encode_ordinary(row.text)


def test_bpe_on_long_words(bpe, tik):
    random.seed(1)
    for word in ("a" * 50_000, "".join(random.choice("abcdefgh") for _ in range(50_000))):
        assert bpe.encode(word) == tik.encode_ordinary(word)


def test_words_of_letters_are_not_split_again(bpe, tik):
    """New words of plain letters after a space need no pattern; greedy and other segmentations are the library's, for any pattern."""
    rng, texts = random.Random(8), []
    for _ in range(3000):
        words = ("".join(rng.choice("aeinorstéß") for _ in range(rng.randint(1, 14))) for _ in range(4))
        texts.append(rng.choice([" ", "\n ", ""]) + rng.choice([" ", "  ", "\u3000 ", ", "]).join(words))
    own = byte_bpe.ByteBpe(bpe.ranks)
    asked, split = [], own.split
    own.split = lambda text: asked.append(text) or split(text)
    for text in texts:
        assert own.encode(text) == tik.encode_ordinary(text)
    assert asked and not any(a[0] == " " and a[1:].isascii() and a[1:].isalpha() for a in asked)
    single = byte_bpe.ByteBpe(bpe.ranks, r"(?s:.)")
    assert single.encode("ab cd") == [bpe.ranks[c.encode()] for c in "ab cd"]


def test_token_digests_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (3, " ")]
    docs = spark.createDataFrame(rows, DOCS)
    found = sorted((r.doc_id or 0, r.n_tokens) for r in byte_bpe.token_digests(docs).collect())
    assert found == [(0, 2), (1, 0), (2, 0), (2, 0), (3, 1)]
    assert byte_bpe.encode_texts(docs).where("doc_id = 3").first().decoded == b" "
    assert byte_bpe.token_digests(docs.limit(0)).count() == 0


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_packing_ids_equal_the_library(text):
    path = public_tokenizers.path(packing.VOCABULARY)
    assert packing.encoder(path).encode(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


LIBRARY = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


@settings(max_examples=200, deadline=None)
@given(st.sampled_from([4, 8, 16]), st.lists(st.integers(1, 40), min_size=1, max_size=6), st.randoms())
def test_cuts_cost_least(window, lengths, chance):
    total = sum(lengths)
    sentences = np.array(sorted(chance.sample(range(1, total + 1), chance.randint(0, total // 3))), dtype=np.int64)
    places, cost = packing.cut_places(np.cumsum(lengths), sentences, window)
    places, cost = places.tolist(), cost.tolist()
    best = {0: 0}
    for place, extra in zip(places, cost):
        best[place] = min(best[j] + packing.padding(place - j, window) for j in best if place - window <= j < place) + extra + packing.SEQUENCE
    cuts, by_place = packing.best_cuts(places, cost, window), dict(zip(places, cost))
    spent = sum(packing.padding(b - a, window) + by_place[b] + packing.SEQUENCE for a, b in zip([0, *cuts], cuts))
    assert cuts[-1] == total and all(0 < b - a <= window for a, b in zip([0, *cuts], cuts)) and spent == best[total]


def test_every_id_lies_in_one_piece(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "x" * 30_000), (-3, "x" * 30_000), (None, "a b")], DOCS)
    pieces = packing.pack(docs.select("doc_id", "text").unionByName(odd)).collect()
    ids = {r.doc_id: [*LIBRARY.encode(r.text or "", add_special_tokens=False).ids, 0] for r in docs.unionByName(odd, True).collect()}
    by_document, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length == len(p.ids) and p.doc_tokens == len(ids[p.doc_id])
        assert p.ids == ids[p.doc_id][p.start : p.start + p.length]
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, dtype="<u4").tobytes())
        by_document[p.doc_id].append((p.start, p.length))
        by_sequence[p.sequence_id].append((p.offset, p.length))
    for doc_id, own in by_document.items():
        assert sum(n for _, n in own) == len(ids[doc_id]) * (2 if doc_id == -3 else 1)
    lengths = []
    for own in by_sequence.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        lengths.append(sum(n for _, n in own))
    assert max(lengths) <= 1024 and sum(packing.padding(n, 1024) for n in lengths) < 0.01 * sum(lengths)
    assert packing.pack(odd.limit(0)).count() == 0
