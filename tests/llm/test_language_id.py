import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import language_id as L

R = random.Random(4)
SYLLABLES = {"aa": ["ka", "lo", "mi", "ta"], "bb": ["sch", "ung", "er", "ein"], "cc": ["eau", "qué", "ment", "la"]}


def made(n, lang=None):
    out = []
    for i in range(n):
        k = lang or R.choice(list(SYLLABLES))
        words = ["".join(R.choice(SYLLABLES[k]) for _ in range(R.randint(1, 3))) for _ in range(R.randint(5, 60))]
        out.append((i, " ".join(words).capitalize() + ".", k))
    return out


def slow_log_p(raw, alphabet, context, c):
    """Kneser-Ney straight from the formula, with n-gram strings."""
    orders = {k: {g: n for g, n in raw.items() if len(g) == k} for k in range(1, L.ORDER + 1)}
    for k in range(L.ORDER, 1, -1):
        for g, n in Counter(g[1:] for g in orders[k]).items():
            orders[k - 1][g] = n

    def p(h, c):
        k = len(h) + 1
        of = Counter(orders[k].values())
        d = of[1] / (of[1] + 2 * of[2]) if of[1] and of[2] else 0.5
        after = {g: n for g, n in orders[k].items() if g[:-1] == h}
        low = p(h[1:], c) if h else 1 / alphabet
        if not after:
            return low
        total = sum(after.values())
        return max(after.get(h + c, 0) - d, 0) / total + d * len(after) / total * low

    return math.log(p(context, c))


def modelled(spark, raw):
    """The identifier of {language: {gram: n}}."""
    rows = [(k, g, n) for k, grams in raw.items() for g, n in grams.items()]
    return L.models(spark.createDataFrame(rows, "lang string, gram string, n long"))


def test_model_matches_the_formula(spark):
    raw = Counter(g for _, t, _ in made(30, "cc") for w in t.lower().split() for g in L.grams(L.letters(w)))
    own = modelled(spark, {"cc": raw})
    alphabet = len({g[-1] for g in raw}) + 1
    words = ["eau", "quément", "x", "laxla", "ééé", "m", ""]
    got, sizes = own.words(words)
    for i, w in enumerate(words):
        want = sum(slow_log_p(raw, alphabet, g[:-1], g[-1]) for g in L.grams(w)) if w else 0
        assert got[i, 0] == pytest.approx(want)
        assert sizes[i] == (len(w) + 1 if w else 0)


def test_probabilities_sum_to_one(spark):
    raw = Counter(g for _, t, _ in made(20, "bb") for w in t.lower().split() for g in L.grams(L.letters(w)))
    raw = {g: n for g, n in raw.items()}
    # One character that no text holds takes what is left.
    m = modelled(spark, {"bb": raw}).models[0]
    for context in ("^", "sch", "ung", "^e", "zz"):
        codes = np.zeros((len({g[-1] for g in raw}), L.ORDER), np.int64)
        for i, c in enumerate(sorted({g[-1] for g in raw})):
            s = context[-3:] + c
            codes[i, L.ORDER - len(s) :] = list(map(ord, s))
        unseen = np.where(np.arange(L.ORDER) == L.ORDER - 1, ord("@"), codes[:1])
        assert np.exp(m.log_p(np.concatenate([codes, unseen]))).sum() == pytest.approx(1, abs=1e-9)


def test_held_out_accuracy_and_edges(spark):
    rows = made(300)
    odd = [(1000, None, "aa"), (1001, "", "bb"), (1002, "123 !!", None), (1003, "Kalo mita kalo", None), (None, "ung er schein", "bb"), (7, "x" * 100_000, None)]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows + odd], "doc_id long, text string, lang string, score double").repartition(5)
    got = L.digest(docs).collect()
    assert len(got) == len(rows) + len(odd)
    truth = {i: k for i, _, k in rows if i != 7}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97
    by_id = defaultdict(list)
    for r in got:
        assert 0 <= r["score"] <= 1
        by_id[r["doc_id"]].append(r)
    for i in (1000, 1001, 1002):
        assert by_id[i][0]["lang_pred"] == "und" and by_id[i][0]["score"] == 0
    assert by_id[1003][0]["lang_pred"] == "aa" and by_id[None][0]["lang_pred"] == "bb"
    assert any(r["rejected"] for r in by_id[7])


def test_reruns_and_held_out_rows(spark):
    rows = made(120)
    schema = "doc_id long, text string, lang string"
    first = sorted(L.digest(spark.createDataFrame(rows, schema).repartition(3)).collect())
    held = {r["doc_id"] for r in first if r["held_out"]}
    turned = [(i, t, "zz" if i in held else k) for i, t, k in rows]
    assert sorted(L.digest(spark.createDataFrame(turned, schema).repartition(7)).collect()) == first


def test_nothing_learnt(spark):
    schema = "doc_id long, text string, lang string"
    got = L.digest(spark.createDataFrame([(1, "words", None)], schema)).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)]
    assert L.digest(spark.createDataFrame([], schema)).count() == 0


def test_cleared_memory_changes_nothing(spark, monkeypatch):
    raw = {k: dict(Counter(g for _, t, _ in made(20, k) for w in t.lower().split() for g in L.grams(L.letters(w)))) for k in ("aa", "bb")}
    texts = [t for _, t, _ in made(40)]
    own = modelled(spark, raw)
    whole = own.judge(texts)
    monkeypatch.setattr(L, "REMEMBERED", 5)
    monkeypatch.setattr(L, "WINDOWS", 40)
    own.clear()
    own.forget()
    for i, t in enumerate(texts):
        one = own.judge([t]).iloc[0]
        assert one["lang_pred"] == whole.iloc[i]["lang_pred"] and one["score"] == pytest.approx(whole.iloc[i]["score"])


def test_a_model_keeps_all_grams(spark):
    """A script of many characters has more grams than 100,000."""
    r = random.Random(6)
    texts = [" ".join("".join(chr(0x4E00 + r.randrange(5000)) for _ in range(3)) for _ in range(100)) for _ in range(450)]
    docs = spark.createDataFrame([(i, t, "zh") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    raw = Counter(g for t in texts for w in t.split() for g in L.grams(w))
    assert len(raw) > 100_000
    got, want = L.train(docs, F.lit(True)).models[0], modelled(spark, {"zh": raw}).models[0]
    assert set(L.hash_strings(list(raw))) <= set(got.grams.keys)
    for mine, whole in ((got.grams, want.grams), (got.contexts, want.contexts)):
        assert np.array_equal(mine.keys, whole.keys) and np.array_equal(mine.values, whole.values)


def test_counts_are_those_of_the_texts(spark, monkeypatch):
    monkeypatch.setattr(L, "COUNTED", 30)
    rows = made(80) + [(900, "Ab-c ab c!! \U0001d400z", "aa"), (901, None, "aa"), (902, "word", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = {(r["lang"], r["gram"]): r["n"] for r in L.counts(docs, "text", "lang").collect()}
    want = Counter((k, g) for _, t, k in rows if t and k for w in t.lower().split() if L.letters(w) for g in L.grams(L.letters(w)))
    assert got == want


def test_columns_and_digest_agree(spark):
    """Scores by columns, in one pass, equal those of the identifier."""
    rows = made(150)
    docs = spark.createDataFrame([(*r, 1.0, "x") for r in rows], "doc_id long, text string, lang string, score double, e string")
    own = L.train(docs, F.lit(True))
    want = own.judge([t for _, t, _ in rows])
    got = L.identified(docs, own).orderBy("doc_id").toPandas()
    assert list(got["lang_pred"]) == list(want["lang_pred"]) and list(got["rejected"]) == list(want["rejected"])
    assert got["score"].to_numpy() == pytest.approx(want["score"].to_numpy())
    assert got["entropy"].to_numpy() == pytest.approx(want["entropy"].to_numpy())
    assert set(got["e"]) == {"x"}


def test_limits_come_from_all_texts(spark, monkeypatch):
    rows = made(700)
    monkeypatch.setattr(L, "SAMPLE", 5)
    own = L.train(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4), F.lit(True))
    e, _ = own.entropies([t for _, t, _ in rows])
    for j, k in enumerate(own.names):
        mine = e[[i for i, r in enumerate(rows) if r[2] == k], j]
        want = np.quantile(mine, L.WITHIN, method="inverted_cdf")
        assert want <= own.limits[j] <= want + 1 / 4096 + 1e-9
