import random

import numpy as np
import pytest

from ledgerlens.llm import jaccard_join as J
from ledgerlens.llm.graph import components


def brute_sets(texts):
    out = []
    for t in texts:
        w = "".join(c.lower() if c.isascii() else c for c in t or "")
        w = [x for x in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in w).split(" ") if x]
        out.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    return out


def brute(rows):
    sets = brute_sets([t for _, t in rows])
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]) and label[i] != label[j]:
                x, y = label[i], label[j]
                label = [y if v == x else v for v in label]
    least = {}
    for v, (i, _) in zip(label, rows):
        least.setdefault(v, []).append(i)
    least = {v: min((i for i in ids if i is not None), default=None) for v, ids in least.items()}
    return sorted(((i, len(s), least[v]) for (i, _), s, v in zip(rows, sets, label)), key=str), label


def run(spark, rows):
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n int").repartition(5)
    return docs, J.joined(docs)


def digest(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def families(seed, n, sizes):
    """Texts, and copies of them with a few words changed, cut off or added; shared passages."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(40)]
    rows = []
    for _ in range(n):
        base = [word() for _ in range(r.randint(*sizes))]
        if r.random() < 0.5:
            at = r.randrange(len(base))
            base[at:at] = passage[: r.randint(10, 40)]
        for _ in range(r.choice([1, 1, 2, 3, 12])):
            copy = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 40))):
                copy[r.randrange(len(copy))] = word()
            if r.random() < 0.3:
                copy = copy[: -r.randint(1, 1 + len(copy) // 12)]
            rows.append(" ".join(copy) if r.random() < 0.9 else "\n".join(copy).upper())
    r.shuffle(rows)
    return [(i * 3 % 1009, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize(("seed", "sizes", "small"), [(1, (30, 120), True), (2, (5, 30), True), (3, (60, 300), False)])
def test_components_equal_brute_force(spark, monkeypatch, seed, sizes, small):
    if small:  # long lists, large components and blocks at the size of a test
        monkeypatch.setattr(J, "LONG", 3)
        monkeypatch.setattr(J, "CELL", 6)
        monkeypatch.setattr(J, "BLOCK", 4)
        monkeypatch.setattr(J, "BROADCAST_ROWS", 3, raising=False)
    rows = families(seed, 60, sizes)
    assert digest(run(spark, rows)[1]) == brute(rows)[0]


def test_a_chain_of_near_copies(spark, monkeypatch):
    """Neighbours are linked, ends are far apart; all lists are long and the leader links few."""
    monkeypatch.setattr(J, "LONG", 3)
    monkeypatch.setattr(J, "CELL", 10)
    monkeypatch.setattr(J, "BLOCK", 7)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 100])) for i in range(60)]
    got = digest(run(spark, rows)[1])
    assert got == brute(rows)[0]
    assert {c for _, _, c in got} == {0}


def test_edges(spark):
    long_ = " ".join(f"x{i % 5000}" for i in range(30_000))
    rows = [(5, None), (4, ""), (4, " \n"), (9, "one"), (3, "One"), (7, "one two"), (None, "one two three four"), (8, "One two three FOUR"),
            (None, "alone here in this text"), (2, long_), (1, long_), (1, long_), (6, "É a b c d"), (10, "é a b c d"), (11, "a\x1cb c d e")]
    docs, got = run(spark, rows)
    assert digest(got) == brute(rows)[0]
    kept = J.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(brute(rows)[1]))
    assert digest(J.joined(kept)) == brute([(r["doc_id"], r["text"]) for r in kept.collect()])[0]


def test_one_of_each_keeps_the_smallest_id(spark):
    rows = families(4, 30, (20, 80))
    docs, got = run(spark, rows)
    want = {c for _, _, c in digest(got)}
    assert sorted(r["doc_id"] for r in J.one_of_each(docs).collect()) == sorted(want)


def test_empty(spark):
    docs, got = run(spark, [])
    assert got.count() == 0 and J.one_of_each(docs).count() == 0


def test_search_counts_exactly():
    r = np.random.default_rng(1)
    sets = [np.unique(r.zipf(1.3, r.integers(5, 200)) % 300) for _ in range(80)]
    index = J.Lists(sets)
    for x in range(80):
        for t in (1, 2, len(sets[x]) // 2 + 1, len(sets[x])):
            found, shared = index.search(x, t, np.zeros(80, bool))
            want = {y: len(np.intersect1d(sets[x], sets[y])) for y in range(80)}
            assert dict(zip(found.tolist(), shared.tolist())) == {y: c for y, c in want.items() if c >= t}


def test_components_of_a_graph(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 560)]
    label = {v: v for e in edges for v in e}
    for _ in range(len(edges)):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = components(spark.createDataFrame(edges, "a long, b long"), "t").collect()
    loops = {a for a, b in edges if a == b}
    assert {r["node"]: r["component"] for r in got} == {v: c for v, c in label.items() if v not in loops or any(v in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0
