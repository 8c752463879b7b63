import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlens.llm import token_files as T
from ledgerlens.session import work_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)
ROWS = [
    (5, None), (None, "no id"), (3, ""), (9, "the the the the"), (3, "tie of the id"), (3, "tie of the id"),
    (1, " lead\n\ttab \n end "), (2, "<|endoftext|> é 中\x00😀\x85 x"), (8, "long text\nwith words " * 5000), (-4, "\n"),
]


def ids(text):
    return LIB.encode(text or "", add_special_tokens=False).ids + [2]


def test_files_round_trip(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in ROWS], "doc_id long, text string, start int")
    folder = work_folder(spark, "t")
    got = T.digest(docs, PATH, 2, folder).collect()
    want, before = [], 0
    for i, t in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, len(ids(r[1])))):
        x = np.array(ids(t), "<u4")
        want.append((i, before, len(x), zlib.crc32(x.tobytes())))
        before += len(x)
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == want
    ranks = spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()
    assert [r["rank"] for r in ranks] == list(range(len(ranks)))
    assert [-r["count"] for r in ranks] == sorted(-r["count"] for r in ranks)
    assert sum(r["count"] for r in ranks) == before


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert T.digest(docs, PATH, 2, work_folder(spark, "t")).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300)))
def test_codes_round_trip(values):
    v = np.array(values, np.uint32)
    control, data = T.pack(v)
    assert len(control) == -(-len(v) // 4)
    assert T.unpack(control, data, len(v)).tolist() == values


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"])) | st.text("aeht \n\t\r.,'s1é\x1c\x85", max_size=40), max_size=4))
def test_any_text(texts):
    got = T.tokenizer(PATH).encode(texts)
    assert [x.tolist() for x in got] == [ids(t)[:-1] for t in texts]


@pytest.mark.parametrize("limit", [1, 7])
def test_cleared_cache_changes_nothing(limit, monkeypatch):
    monkeypatch.setattr(T, "STEMS", limit)
    monkeypatch.setattr(T, "LINES", 2)
    own = T.ByteTokenizer(PATH)
    for _, t in ROWS:
        assert own.encode([t])[0].tolist() == ids(t)[:-1]


KINDS = [
    "Caf\u00e9 na\u00efve, \u0100\u0101\u024f. \u00d7 \u00f7 \u0250 word., word,. a.b don't 's\n's don't\n(x) .,\n., 12 3.4 ab1",
    "\u4e2d\u6587 \u4e2d\u6587.\n\u4e2d, \U0001f600\n\U0001f600 \u0308e e\u0308 \u0120x \u010ax\n\u010ax \u0100 \u0000 a\u0000b\n\u0000 \u1e9e\u00df",
    " \u00e9",
]


@pytest.mark.parametrize("text", KINDS)
def test_kinds_of_segments(text):
    assert T.ByteTokenizer(PATH).encode([text, text[::-1]])[0].tolist() == ids(text)[:-1]


class Counting:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, lib):
        self.lib, self.texts = lib, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.lib.encode_batch_fast(texts, **options)


def test_library_gets_segments_of_all_kinds_some_hundred_at_a_time():
    own = T.ByteTokenizer(PATH)
    own.lib, own.pieces = Counting(own.lib), Counting(own.pieces)
    words = [chr(97 + i % 26) + chr(97 + i // 26 % 26) + chr(97 + i // 676) for i in range(2000)]
    text = " ".join(words) + "\n" + "\n".join(f"{w}\u00e9," for w in words) + " " + " ".join(f"{w}-{w}" for w in words)
    assert own.encode([text])[0].tolist() == ids(text)[:-1]
    assert own.lib.texts + own.pieces.texts <= 3 * (2000 // T.LINES + 1)


@pytest.mark.parametrize("taken", [1, 300, 1 << 20])
def test_gathered_batches_keep_rows(taken, monkeypatch):
    monkeypatch.setattr(T, "TAKEN", taken)
    batches = [T.pa.RecordBatch.from_pydict({"text": ["x" * 40] * n, "at": [k] * n}) for k, n in enumerate([3, 1, 5, 2])]
    got = list(T.gathered(iter(batches)))
    assert T.pa.Table.from_batches(got) == T.pa.Table.from_batches(batches).combine_chunks()
    assert all(b.nbytes >= taken for b in got[:-1])
    assert list(T.gathered(iter([]))) == []
