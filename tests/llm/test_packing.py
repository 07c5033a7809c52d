import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hourgrid.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", "   ", "a b c  d", "ệx é ́z 'S it's I'LL don't", "İstanbul ΣΑΣ ς", "x<|endoftext|>y z", "12 3a4 ¼x² _a_ \x1c q \x85 r",
    "​ ﻿中文 デ 한글", "'s", "a　", "\xa0", "!!! ... @@", "long " * 3000, "x" * 5000, "\U0001f600 ok \U0001f600",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("stretch", [1 << 20, 5])
def test_ids_are_the_tokenizers(tokenizer, monkeypatch, stretch):
    monkeypatch.setattr(packing, "STRETCH", stretch)
    words = packing.WordIds(PATH)
    for text in [t or "" for t in TEXTS] * 2:
        assert np.frombuffer(words(text), "<u4").tolist() == ids(tokenizer, text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_ids_of_any_text(texts):
    tokenizer = Tokenizer.from_file(PATH) if "t" not in CACHE else CACHE["t"]
    words = CACHE.setdefault("w", packing.WordIds(PATH))
    CACHE["t"] = tokenizer
    for text in texts:
        assert np.frombuffer(words(text), "<u4").tolist() == ids(tokenizer, text)


CACHE = {}


def test_memory_is_bounded(tokenizer):
    words = packing.WordIds(PATH, 3)
    for text in ("one two three four five", "six seven eight one two", "one nine ten"):
        assert np.frombuffer(words(text), "<u4").tolist() == ids(tokenizer, text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=30))
def test_packing_covers_every_rest_once(lengths):
    windows = packing.pack([(n, k) for k, n in enumerate(lengths)], 64)
    seen = defaultdict(list)
    for window in windows:
        total = sum(n for *_, n in window)
        assert total & (total - 1) == 0 and 0 < total <= 64
        for number, at, n in window:
            seen[number].append((at, n))
    for k, length in enumerate(lengths):
        at = 0
        for start, n in sorted(seen[k]):
            assert start == at and n > 0
            at += n
        assert at == length


def check(tokenizer, docs, pieces, longest=2048):
    """Every id lies in exactly one piece, sequences are gapless and powers of two, checksums hold."""
    by_doc, by_sequence, groups = defaultdict(list), defaultdict(list), defaultdict(dict)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
        groups[p.step_group][p.sequence_id] = p.sequence_length
    assert set(by_doc) == {i for i, _ in docs}
    for i, text in docs:
        raw = np.array([*ids(tokenizer, text), 1], "<u4").tobytes()
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(raw) // 4
            assert p.ids_crc32 == zlib.crc32(raw[4 * at : 4 * (at + p.length)])
            at += p.length
        assert at == len(raw) // 4
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= longest and at & (at - 1) == 0 and {p.sequence_length for p in parts} == {at}
    assert all(sum(g.values()) <= packing.STEP_TOKENS for g in groups.values())


def test_edge_rows(spark, tokenizer):
    docs = [(i, t) for i, t in enumerate(TEXTS)]
    frame = spark.createDataFrame([(i, t, "x", 5) for i, t in docs], "doc_id long, text string, start string, length int")
    check(tokenizer, docs, packing.pack_documents(frame, PATH).collect())
    twice = packing.pack_documents(spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string"), PATH).collect()
    assert sorted((p.doc_id or 0, p.length) for p in twice) == [(0, 2), (1, 3), (1, 3)] or sum(p.length for p in twice) == 8
    assert packing.pack_documents(frame.limit(0), PATH).count() == 0


def test_query(spark, sf_dir, tokenizer):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check(tokenizer, docs, queries.op10_packing(spark, sf_dir).collect())


def test_frequent_words_are_learnt_once():
    learnt = []

    class Watched(packing.WordIds):
        def _learn(self, words):
            learnt.extend(words)
            super()._learn(words)

    found = Watched(PATH, words_kept=40)
    for n in range(300):
        text = f"often met, word{n} other{n % 90}"
        assert found(text) == found.encoded(text)
    assert learnt.count(b"often") == learnt.count(b"met,") == 1
    assert learnt.count(b"other0") == 4  # a word that comes back after all that may be kept
    assert len(found.words) + len(found.older_words) <= 50
