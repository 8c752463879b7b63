import hashlib
import random
import string
import time

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import sentence_pieces as S

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=PATH)
TEXTS = [
    None, "", " ", "   ", "\n\t", "▁", " ▁ a", "plain words here", "é ﬁ 中文 😀 \x00 \x85",
    "a" * 3000, " " * 2000, "thethe" * 900, "中文字" * 500, "same", "same", "<s> <0x0A> </s> <unk>",
    "long words and more " * 4000,
]


def test_encode_and_decode_equal_the_library(spark):
    rows = [(i // 2 or None, t, "x") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = S.decode(S.encode(docs, PATH), PATH).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        assert r["ids"] == LIB.encode(r["text"] or "")
        assert r["decoded"] == LIB.decode(r["ids"]) == (r["text"] or "").replace("▁", " ")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"])) | st.text("aeht▁ \n.,é0中", max_size=80), max_size=5))
def test_any_text(texts):
    flat, counts = S.model(PATH).encode(texts)
    assert flat.tolist() == [i for t in texts for i in LIB.encode(t)]
    assert counts.tolist() == [len(LIB.encode(t)) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(3, 31_999), max_size=30))
def test_any_ids_decode(ids):
    assert S.model(PATH).decode(ids) == LIB.decode(ids)


def test_chunks_and_cleared_cache_change_nothing(monkeypatch):
    want = [LIB.encode(t or "") for t in TEXTS]
    monkeypatch.setattr(S, "CHARS_AT_ONCE", 7)
    own = S.PieceModel(PATH)
    monkeypatch.setattr("ledgerlens.llm.segments.REMEMBERED", 3)
    for t, ids in zip(TEXTS, want, strict=True):
        assert own.encode([t])[0].tolist() == ids


def test_digest(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    for r in S.digest(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect():
        ids = LIB.encode(TEXTS[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(LIB.decode(ids).encode()).hexdigest()
    assert S.digest(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


R = random.Random(9)
STRETCHES = {
    "base62": lambda n: "".join(R.choice(string.ascii_letters + string.digits) for _ in range(n)),
    "letters": lambda n: "".join(R.choice(string.ascii_lowercase) for _ in range(n)),
    "words without spaces": lambda n: "".join(R.choice(["function", "return", "the", "value", "(x)", "this.", "=>", "{", "}"]) for _ in range(n // 5)),
    "Chinese": lambda n: "".join(chr(0x4E00 + R.randrange(3000)) for _ in range(n)),
    "one letter": lambda n: "a" * n,
    "spaces": lambda n: " " * n,
    "two letters": lambda n: "ab" * (n // 2),
}


@pytest.mark.parametrize("kind", STRETCHES)
def test_long_stretches_take_time_in_proportion(kind):
    text = STRETCHES[kind](1_000_000)
    own = S.PieceModel(PATH)
    start = time.perf_counter()
    flat, _ = own.encode([text])
    assert time.perf_counter() - start < 60
    assert flat.tolist() == LIB.encode(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aeh t▁中0", max_size=300) | st.text("etaoinshr", min_size=5, max_size=300), max_size=3))
def test_cutting_changes_nothing(texts):
    own = S.model(PATH)
    own.cache.clear()
    before, S.LONG = S.LONG, 3
    try:
        assert own.encode(texts)[0].tolist() == [i for t in texts for i in LIB.encode(t)]
    finally:
        S.LONG = before
        own.cache.clear()
