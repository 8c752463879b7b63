"""Toxicity from confirmed toxic examples and unlabelled text.

A linear model over the words of a text and their beginnings is trained with numpy on the non-negative
positive-unlabelled risk: prior * E_P[l(z)] + max(0, E_U[l(-z)] - prior * E_P[l(-z)]), with the
logistic loss.  Unlabelled texts are drawn from all texts, toxic or not, so the second part
corrects them for the toxic ones among them by the class prior; where a batch makes that part
negative, the step undoes it in place of following it.

The sample that the model is fitted on is bounded (``POSITIVE``, ``UNLABELLED``, ``VOCABULARY``);
every text is scored whole.

Defined results: a null or empty text has no words, its score is that of the intercept.  Labels of
rows that are held out, null labels and null ids teach nothing; without any toxic label, or any
text, the score is the prior (0 without labels).  Repeated rows are scored alike.  An empty table
gives no row.  Columns of the input stay, added ones replace those of their name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import free_name, held_out, session_of, stored

#: Texts that the model is fitted on, and features that it may know.
POSITIVE, UNLABELLED, VOCABULARY = 2_000, 8_000, 2_000
#: Texts of the sample that a feature occurs in at least, and standard errors that its shares of
#: toxic and of all texts are apart at least.
LEAST_TEXTS, LEAST_Z = 5, 6.0
BEGINNINGS = (3, 4, 5, 6)
STEPS, RATE, DECAY = 300, 0.1, 1e-4
BATCHES = 4
THRESHOLD = 0.7
PUNCTUATION = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))


def features(text: str | None) -> set[str]:
    """The words of a text and their beginnings, which carry inflected and compound words."""
    whole = {w.strip(PUNCTUATION) for w in set((text or "").lower().split())}
    out = {f"{w}$" for w in whole}
    for k in BEGINNINGS:
        out.update([w[:k] for w in whole if len(w) >= k])
    return out


@dataclass
class Model:
    weights: dict[str, float]
    intercept: float

    def scores(self, texts: Iterator[str | None]) -> np.ndarray:
        known, weight = self.weights.keys(), self.weights
        # In a fixed order, so that sums are equal in reruns.
        z = [self.intercept + sum(sorted(weight[w] for w in known & features(t))) for t in texts]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


class Texts:
    """Word numbers of texts, one text after another."""

    def __init__(self, texts: list[set[str]], number: dict[str, int]):
        lists = [sorted(number[w] for w in t if w in number) for t in texts]
        self.n = len(texts)
        self.at = np.array([i for x in lists for i in x], np.int64)
        self.row = np.repeat(np.arange(self.n), [len(x) for x in lists])

    def part(self, k: int, of: int) -> Texts:
        """Every ``of``-th text."""
        out = Texts([], {})
        mine = self.row % of == k
        out.n, out.at, out.row = len(range(k, self.n, of)), self.at[mine], self.row[mine] // of
        return out

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.at], self.n) + w[-1]

    def back(self, slopes: np.ndarray, size: int) -> np.ndarray:
        out = np.bincount(self.at, slopes[self.row], size)
        out[-1] = slopes.sum()
        return out


def fit(positive: list[set[str]], unlabelled: list[set[str]], names: list[str], prior: float) -> Model:
    """Minimise the risk over the features ``names`` by Adam; the last weight is the intercept."""
    number = {w: i for i, w in enumerate(names)}
    p_all, u_all = Texts(positive, number), Texts(unlabelled, number)
    of = BATCHES if min(p_all.n, u_all.n) >= 50 * BATCHES else 1
    batches = [(p_all.part(k, of), u_all.part(k, of)) for k in range(of)]
    size = len(names) + 1
    w, first, second = np.zeros(size), np.zeros(size), np.zeros(size)
    w[-1] = np.log(prior / (1 - prior))
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    loss = lambda z: np.logaddexp(0, -z)
    for step in range(1, STEPS + 1):
        p, u = batches[step % of]
        zp, zu = p.dot(w), u.dot(w)
        negative = loss(-zu).mean() - prior * loss(-zp).mean()
        slope = u.back(sigmoid(zu) / u.n, size) - prior * p.back(sigmoid(zp) / p.n, size)
        if negative >= 0:
            slope += prior * p.back(-sigmoid(-zp) / p.n, size)
        else:
            slope = -slope
        slope[:-1] += DECAY * w[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        rate = RATE / np.sqrt(1 + step / 50)
        w = w - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model({x: float(w[i]) for x, i in number.items() if w[i]}, float(w[-1]))


def sample(docs: DataFrame, ids: DataFrame, most: int, text: str) -> DataFrame:
    """(doc_id, text) of the ``most`` ids first by hash; only ids are sorted, never texts."""
    chosen = ids.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")


def telling(texts: DataFrame, n_p: int, n_u: int) -> list[str]:
    """Features whose share of toxic texts differs from their share of all texts by at least
    ``LEAST_Z`` standard errors, the farthest first; ``texts`` has text and toxic."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n: dict[bool, Counter] = {True: Counter(), False: Counter()}
            for t, toxic in zip(b["text"], b["toxic"], strict=True):
                n[toxic].update(features(t))
            rows = [(w, n[True][w], n[False][w]) for w in n[True] | n[False]]
            if rows:
                yield pd.DataFrame(rows, columns=["feature", "p", "u"])

    counts = texts.select("text", "toxic").mapInPandas(count, "feature string, p long, u long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    share = (F.col("p") + F.col("u") + 1) / (n_p + n_u + 2)
    z = F.abs(F.col("p") / n_p - F.col("u") / n_u) / F.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u))
    far = counts.filter((F.col("p") + F.col("u") >= LEAST_TEXTS) & (F.col("p") > 0)).withColumn("z", z).filter(F.col("z") >= LEAST_Z)
    return [r["feature"] for r in far.orderBy(F.desc("z"), "feature").limit(VOCABULARY).collect()]


def train(docs: DataFrame, labels: DataFrame, learn: Column, text: str = "text") -> Model:
    """Fit on rows of ``docs`` and ``labels`` (doc_id, toxic) where ``learn``, a condition on doc_id."""
    session_of(docs)
    known = labels.filter(learn & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    n = known.agg(F.count("*").alias("all"), F.sum("toxic").alias("toxic")).first()
    if not n["toxic"]:
        return Model({}, -500.0)
    prior = min(max(n["toxic"] / n["all"], 1e-4), 1 - 1e-4)
    ids = docs.filter(learn & F.col("doc_id").isNotNull()).select("doc_id")
    toxic = ids.join(known.filter("toxic = 1").select("doc_id"), "doc_id", "left_semi")
    texts = sample(docs, toxic, POSITIVE, text).withColumn("toxic", F.lit(True))
    texts = stored(texts.union(sample(docs, ids, UNLABELLED, text).withColumn("toxic", F.lit(False))), "toxic-sample")
    size = texts.agg(F.count_if("toxic").alias("p"), F.count_if(~F.col("toxic")).alias("u")).first()
    if not size["p"]:
        return Model({}, float(np.log(prior / (1 - prior))))
    names = telling(texts, size["p"], size["u"])
    wanted = frozenset(names)

    def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "toxic": b["toxic"], "features": [sorted(wanted & features(t)) for t in b["text"]]})

    # A row for each text of the sample, with the chosen features only, in a fixed order.
    rows = texts.mapInPandas(reduced, "doc_id long, toxic boolean, features array<string>").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["features"]))
    positive, unlabelled = ([set(r["features"]) for r in rows if r["toxic"] == side] for side in (True, False))
    return fit(positive, unlabelled, names, prior)


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with score and predicted."""
    spark = session_of(docs)
    shared = spark.sparkContext.broadcast(model)  # at most ``VOCABULARY`` words

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.scores(texts), dtype="float64")

    at = free_name(docs, "toxic_score")
    out = docs.withColumn(at, score(F.col(text)))
    return out.withColumns({"score": F.col(at), "predicted": (F.col(at) >= THRESHOLD).cast("int")}).drop(at)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every document with a model that never saw the labels or texts of the third fold."""
    docs = docs.select("doc_id", "text")
    out = held_out("doc_id", 3, 1)
    model = train(docs, labels.select("doc_id", "toxic"), ~out)
    return scored(docs, model).select("doc_id", out.alias("held_out"), "score", "predicted")
