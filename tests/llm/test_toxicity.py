import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import toxicity as T

R = random.Random(3)
BAD = ["nastig", "nastiger", "vilest", "scorn", "scornful"]


def made(n, toxic_share=0.2):
    rows = []
    for i in range(n):
        bad = R.random() < toxic_share
        ws = [R.choice("the of and it was here there some word other thing".split()) for _ in range(R.randint(20, 120))]
        if bad:
            for _ in range(max(3, len(ws) // 15)):
                ws[R.randrange(len(ws))] = R.choice(BAD).title() + R.choice(["", ".", "!"])
        rows.append((i, " ".join(ws), int(bad)))
    return rows


def test_learns_from_positives_and_unlabelled_alone():
    rows = made(2500)
    positive = [T.features(t) for _, t, y in rows if y][:150]
    unlabelled = [T.features(t) for _, t, _ in rows[:1200]]
    names = sorted(f for f in set().union(*positive) if sum(f in t for t in positive) >= 20)
    model = T.fit(positive, unlabelled, names, 0.2)
    rest = rows[1200:]
    s, y = model.scores(t for _, t, _ in rest), np.array([r[2] for r in rest])
    assert (s[y == 1] >= T.THRESHOLD).mean() > 0.9
    assert (s[y == 0] >= T.THRESHOLD).mean() < 0.02


def test_slope_is_that_of_the_risk():
    """A step of plain differences agrees with the gradient parts."""
    texts = [set("ab"), set("bc"), set("c"), set("a")]
    x = T.Texts(texts, {"a": 0, "b": 1, "c": 2})
    w = np.array([0.3, -0.2, 0.5, 0.1])
    loss = lambda v: np.logaddexp(0, -x.dot(v)).mean()
    slope = x.back(-1 / (1 + np.exp(x.dot(w))) / x.n, 4)
    for i in range(4):
        e = np.zeros(4)
        e[i] = 1e-6
        assert slope[i] == pytest.approx((loss(w + e) - loss(w - e)) / 2e-6, abs=1e-6)
    assert [x.part(k, 2).n for k in (0, 1)] == [2, 2]


def test_held_out_labels_teach_nothing(spark):
    rows = made(400)
    docs = spark.createDataFrame([(i, t, 0.5) for i, t, _ in rows], "doc_id long, text string, score double")
    out = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    labels = [(i, y) for i, _, y in rows if R.random() < 0.8]
    turned = [(i, 1 - y if out(i) else y) for i, y in labels]
    got = [T.digest(docs, spark.createDataFrame(x, "doc_id long, toxic int")).orderBy("doc_id").collect() for x in (labels, turned)]
    assert got[0] == got[1]
    assert [r["held_out"] for r in got[0]] == [out(i) for i, _, _ in rows]
    for r in got[0]:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    hits = [r["predicted"] == rows[r["doc_id"]][2] for r in got[0] if r["held_out"]]
    assert np.mean(hits) > 0.85


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(1, 1)], [(None, 1), (2, None)], [(7, 1), (7, 1), (8, 0)]])
def test_odd_rows(spark, labels):
    rows = [(1, None), (2, ""), (None, "some text"), (2, "same"), (2, "same"), (3, "!!! ..."), (4, "x" * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = T.digest(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] in (0, 1) and r["held_out"] in (True, False)
    assert T.digest(docs.limit(0), spark.createDataFrame(labels, "doc_id long, toxic int")).count() == 0


def test_columns_stay(spark):
    docs = spark.createDataFrame([(1, "t", "old")], "doc_id long, body string, predicted string")
    got = T.scored(docs, T.Model({"t$": 2.0}, 0.0), "body")
    assert got.columns == ["doc_id", "body", "predicted", "score"]
    assert got.select(F.round("score", 4)).first()[0] == pytest.approx(0.8808)
