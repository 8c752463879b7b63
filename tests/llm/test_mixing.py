import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import mixing as M


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, limit=2):
    """Share by weight, stop who is above the limit, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, got, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        level = (budget - sum(got.values())) / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > limit * sizes[s]}
        if not over:
            return got | {s: level * w[s] for s in open_}
        got |= {s: float(limit * sizes[s]) for s in over}
        open_ -= over
    return got


def sample(n, seed=1):
    r = random.Random(seed)
    names = ["a", "Z", "é", None, "b", "c", ""]
    return [
        (i, " ".join(["w"] * max(0, int(r.lognormvariate(4, 1)))) if i % 37 else None, r.choice(names + ["a"] * 6), -1)
        for i in range(n)
    ]


SCHEMA = "doc_id long, text string, source string, target long"


def test_targets_sizes_and_copies(spark):
    rows = sample(4000)
    got = M.mixed(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert len(got) == len(rows)
    texts = {r[0]: r for r in rows}
    sizes, taken = {}, {}
    for r in got:
        size = len((texts[r["doc_id"]][1] or "").split())
        assert r["size"] == size and r["taken"] == r["copies"] * size <= 2 * size
        sizes[r["source"]] = sizes.get(r["source"], 0) + size
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    want = brute_targets(sizes)
    largest = max(r["size"] for r in got)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-12)
    for s, t in taken.items():
        assert abs(t - want[s]) <= largest / 2


def test_whole_order_gives_the_same_cut(spark, monkeypatch):
    """The cut by bins equals the cut of each source sorted as a whole."""
    docs = spark.createDataFrame(sample(1500, 2), SCHEMA)
    want = {r["doc_id"]: r["copies"] for r in M.mixed(docs).collect()}
    monkeypatch.setattr(M, "BINS", 1)
    assert {r["doc_id"]: r["copies"] for r in M.mixed(docs.repartition(3)).collect()} != {} and want
    monkeypatch.undo()
    assert {r["doc_id"]: r["copies"] for r in M.mixed(docs.repartition(7)).collect()} == want


def test_larger_documents_are_likelier(spark):
    rows = [(i, "w " * (1 + i % 10), "s", 0) for i in range(20_000)]
    got = M.mixed(spark.createDataFrame(rows, SCHEMA), share=0.3)
    rate = {r["size"]: r["p"] for r in got.groupBy("size").agg({"copies": "avg"}).toDF("size", "p").collect()}
    words = sum(len(r[1].split()) for r in rows)
    scale = 0.3 * words / sum(len(r[1].split()) ** 2 for r in rows)
    for size, p in rate.items():
        assert p == pytest.approx(scale * size, abs=0.03)


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(1, None, None, 0)],
        [(1, "", "a", 0), (2, " \t", None, 0)],
        [(None, "one two three", None, 0)] * 5 + [(7, "x", "b", 0)] * 3,
        [(1, "w " * 200_000, "a", 0), (2, "w", "a", 0), (2, "w", "b", 0)],
    ],
)
def test_edges(spark, rows):
    got = M.mixed(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 0, "b": 5}, {"a": 100, "b": 1, "c": 1, "d": 50}, {None: 9, "": 8, "z": 1000}])
def test_levels(spark, sizes):
    rows = [(k or "", k is None, v) for k, v in sizes.items()]
    got = M.targets(spark.createDataFrame(rows, "_key string, _none boolean, source_size long")).collect()
    want = brute_targets(sizes)
    assert {None if r["_none"] else r["_key"]: pytest.approx(r["target"]) for r in got} == want


def filled(spark, sizes):
    """Targets of sizes against brute force, and their sum against the budget."""
    rows = [(k or "", k is None, v) for k, v in sizes.items()]
    got = M.targets(spark.createDataFrame(rows, "_key string, _none boolean, source_size long")).collect()
    assert {None if r["_none"] else r["_key"]: pytest.approx(r["target"]) for r in got} == brute_targets(sizes)
    assert sum(r["target"] for r in got) == pytest.approx(1.5 * sum(sizes.values()))
    return got


@pytest.mark.parametrize("n", [3, 7, 20])
def test_equal_sizes_share_the_whole_budget(spark, n):
    filled(spark, {f"s{i:02d}": 100 for i in range(n)})


def test_real_sources_share_the_whole_budget(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sizes = docs.groupBy("source").agg(F.sum(M.words(F.col("text"))).alias("n")).collect()
    got = filled(spark, {r["source"]: r["n"] for r in sizes})
    assert sum(r["target"] < 2 * r["source_size"] for r in got) > 1


@pytest.mark.parametrize("copies,others", [(100, 0), (100, 40), (3000, 7)])
def test_of_equal_rows_as_many_as_fill_the_target(spark, copies, others):
    """A source of repeated rows below its limit meets its target like any other."""
    rows = [(1, " ".join(["w"] * 10), "b", -1)] * copies
    rows += [(100 + i, " ".join(["w"] * (5 + i % 9)), "b", -1) for i in range(others)]
    rows += [(9000 + i, " ".join(["w"] * 7), "a", -1) for i in range(copies)] + [(None, None, "b", -1)] * 3
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = M.mixed(docs).collect()
    assert len(got) == len(rows)
    sizes, taken = {}, {}
    for r in got:
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    want = brute_targets(sizes)
    for s in want:
        assert abs(taken[s] - want[s]) <= 7
    again = M.mixed(docs.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
