import random
import re
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import quality_votes as Q

R = random.Random(11)
WORDS = "the of and it was here there some word other thing under over between house river green".split()


def made(n, bad_share=0.25, seed=4):
    r = random.Random(seed)
    out = []
    for i in range(n):
        bad = r.random() < bad_share
        words = [r.choice(WORDS) for _ in range(r.randint(20, 90))]
        spoilt = (" | ".join(words), "!! ".join(w.upper() for w in words), " ".join(w for w in words for _ in range(4)))[i % 3]
        text = spoilt if bad else " ".join(words) + "."
        out.append((i, text, int(not bad)))
    return out


def out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def test_held_out_labels_are_found_and_teach_nothing(spark):
    rows = made(900)  # more labelled texts of each kind than there are neighbours
    docs = spark.createDataFrame([(i, t, 0.5, "x") for i, t, _ in rows], "doc_id long, text string, score double, label string")
    known = [(i, y) for i, _, y in rows if i % 7]
    turned = [(i, 1 - y if out(i) else y) for i, y in known]
    got = [Q.digest(docs, spark.createDataFrame(x, "doc_id long, quality int")).orderBy("doc_id").collect() for x in (known, turned)]
    assert got[0] == got[1]
    assert [r["held_out"] for r in got[0]] == [out(i) for i, _, _ in rows]
    right = [r["predicted"] == y for r, (_, _, y) in zip(got[0], rows) if r["held_out"]]
    assert sum(right) >= 0.97 * len(right)


def plain(rows, known):
    """Scores by dense matrices, a loop over texts and numpy's own decomposition."""
    features = []
    for _, text in rows:
        count = {}
        tokens = (text or "").split()
        for t, last in zip(tokens, [None, *tokens]):
            for place in [Q.AGAIN] if t == last else Q.buckets_of(t):
                count[place] = count.get(place, 0) + 1
        features.append(count)
    used = sorted(set().union(*features))
    df = {p: sum(p in c for c in features) for p in used}
    a = np.zeros((len(rows), len(used)))
    for i, c in enumerate(features):
        for p, n in c.items():
            a[i, used.index(p)] = (1 + np.log(n)) * (np.log((1 + len(rows)) / (1 + df[p])) + 1)
        length = np.sqrt((a[i] ** 2).sum())
        a[i] /= length or 1
    learn = [k for k, (i, _) in enumerate(rows) if i in known and not out(i)]
    axes = np.linalg.svd(a[learn], full_matrices=False)[2][: Q.RANK].T
    y = a @ axes
    length = np.sqrt((y**2).sum(1, keepdims=True))
    y = np.divide(y, length, out=np.zeros_like(y), where=length > 1e-12)
    labels = np.array([float(known[rows[k][0]]) for k in learn])
    scores = []
    for v in y:
        cosine = y[learn] @ v
        near = [j for j in range(len(learn)) if cosine[j] >= sorted(cosine)[-min(Q.NEIGHBOURS, len(learn))] - 1e-9]
        weight = np.maximum(cosine[near], 0)
        scores.append((weight @ labels[near]) / weight.sum() if weight.sum() else labels.mean())
    return scores


def test_scores_equal_a_plain_computation(spark):
    rows = [(i, t) for i, t, _ in made(150, seed=8)] + [(900, ""), (901, None), (902, "zzz qqq")]
    r = random.Random(1)
    known = {i: r.random() < 0.6 for i, _ in rows if i % 4 and i < 900}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(y)) for i, y in known.items()], "doc_id long, quality int")
    got = {r["doc_id"]: r["score"] for r in Q.digest(docs, labels).collect()}
    assert [got[i] for i, _ in rows] == pytest.approx(plain(rows, known), abs=2e-3)


def test_directions_are_those_of_the_decomposition():
    r = np.random.default_rng(0)
    dense = np.where(r.random((60, 40)) < 0.2, r.random((60, 40)), 0) * np.geomspace(1, 0.01, 40)
    row, at = np.nonzero(dense)
    counts = Q.Counts(60, row, at, np.ones(len(row)))
    axes = Q.directions(counts, dense[row, at], rank=5)[:40]
    want = np.linalg.svd(dense, full_matrices=False)[2][:5].T
    assert np.abs((axes * want).sum(0)) == pytest.approx(np.ones(5), abs=1e-3)
    assert Q.times(row, at, dense[row, at], np.eye(40), 60) == pytest.approx(dense)


def test_ties_all_vote_and_votes_stay_between_zero_and_one():
    e = np.eye(3)
    model = Q.Model(np.ones(1), np.ones((1, 1)), e[[0] * 40 + [1] * 10], np.array([1.0] * 10 + [0.0] * 30 + [1.0] * 10))
    assert model.votes(np.array([e[0], e[1], e[2], e[0] + e[1]])).tolist() == pytest.approx([0.25, 1.0, 0.4, 0.4])


def test_shapes():
    assert [Q.shape(t) for t in ("THE!!", "word,", "a1b22", "||", "Über###", "")] == ["A!", "a,", "a9a9", "|", "Aa#", ""]
    assert Q.buckets_of("***") == (Q.buckets_of("***")[1],) * 2


def test_nulls_empty_long_and_repeated(spark):
    rows = made(120, seed=3)
    long = " ".join(WORDS * 60_000)
    docs = [(i, t) for i, t, _ in rows] + [(5, rows[5][1]), (700, None), (701, ""), (None, rows[7][1]), (702, long)]
    labels = [(i, y) for i, _, y in rows] + [(5, None), (None, 1), (9, 0), (9, 1)]
    got = Q.digest(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(got) == len(docs)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= Q.THRESHOLD)
    assert len(by[5]) == 2 and by[5][0] == by[5][1]
    assert by[700][0]["score"] == by[701][0]["score"]
    assert by[702][0]["predicted"] == 1 and not by[None][0]["held_out"]


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in Q.digest(docs, none).collect()} == {0.0}
    assert Q.digest(spark.createDataFrame([], "doc_id long, text string"), none).collect() == []
    held = next(i for i in range(100) if out(i))
    assert {r["score"] for r in Q.digest(docs, spark.createDataFrame([(held, 1)], "doc_id long, quality int")).collect()} == {0.0}
    empty = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    learn = [i for i in (1, 2) if not out(i)]
    assert {r["score"] for r in Q.digest(empty, spark.createDataFrame([(i, 1) for i in learn], "doc_id long, quality int")).collect()} == {1.0}


def features(text):
    """Count of each place, one token at a time."""
    count = {}
    tokens = (text or "").split()
    for token, last in zip(tokens, [None, *tokens]):
        kinds = "".join("A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c for c in token)
        form = "shape " + re.sub(r"(.)\1+", r"\1", kinds, flags=re.DOTALL)
        word = token.lower().strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
        for place in ["again"] if token == last else ["word " + word if word else form, form]:
            at = zlib.crc32(place.encode()) % Q.BUCKETS
            count[at] = count.get(at, 0) + 1
    return count


ODD = [
    None, "", " \t\n", "  a  a a b ", "\x1cA\x1fB\x85C\u2003D\u3000E\xa0F", "ΟΔΟΣ ΟΔΟΣ, ΣΑΣ Σ ς 'Σ' aΣ\u0301 aΣ\u0301b", "İstanbul ISTANBUL ß ẞ ǅ ª ² Ⅷ ٣٣ 中文字 \U0001d7d8\U0001f600\U0001f600",
    "THE!! *** --- a\x00b \x00\x00 x\u200bx x\u200b \ufeffq e\u0301e\u0301 <<>> [~] {|}", "last first", "first last last", "again again again again x",
]


@pytest.mark.parametrize("characters, kind", [(1, pa.string()), (60, pa.large_string()), (2_000_000, pa.string())])
def test_features_equal_those_of_one_token_after_another(monkeypatch, characters, kind):
    monkeypatch.setattr(Q, "CHARACTERS", characters)
    chars = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    every = ["".join(chars[k : k + 97]) + " " + "q".join(chars[k : k + 97 : 7]) for k in range(0, len(chars), 97 if characters > 60 else 9700)]
    texts = [None, *ODD, *every, *(t for _, t, _ in made(40))]
    got = []
    for part in Q.parts_of(pa.array(texts, kind).slice(1)):  # a slice, as batches may be
        c = Q.counted(part)
        assert c.n == len(part) and (len(part) == 1 or sum(map(len, part.to_pylist())) <= characters)
        rows = [{} for _ in range(c.n)]
        for r, at, n in zip(c.row.tolist(), c.at.tolist(), c.count.tolist()):
            rows[r][at] = n
        got += rows
    assert got == [features(t) for t in texts[1:]]


def test_a_new_token_costs_few_python_calls():
    """Most words of a large table are met once or twice; each must not be a loop over its characters."""
    text, calls = " ".join(f"Word{k}-{k % 97}x" for k in range(20_000)), 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    part = pa.array([text])
    before = sys.getprofile()
    sys.setprofile(count)
    try:
        found = Q.counted(part)
    finally:
        sys.setprofile(before)
    assert found.count.sum() == 40_000 and calls < 3 * 20_000


def test_products_of_repeated_rows_are_equal():
    """Wherever a row lies, its sum is taken in one piece."""
    r = np.random.default_rng(2)
    at, w, dense = np.sort(r.choice(5000, 700, replace=False)), r.random(700), r.random((5000, 8))
    copies = Q.times(np.repeat(np.arange(400), 700), np.tile(at, 400), np.tile(w, 400), dense, 402)
    assert (copies[:400] == copies[0]).all() and not copies[400:].any()
    assert Q.times(np.zeros(0, int), np.zeros(0, int), np.zeros(0), dense, 3).tolist() == np.zeros((3, 8)).tolist()
