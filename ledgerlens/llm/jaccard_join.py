"""N-gram Jaccard join by T-occurrence search (DivideSkip).

A document is the set of hashes of its distinct word shingles.  Two documents of a similarity of
85 % share at least T = 85 % of the larger set, so a document's partners occur T times in the
inverted lists of its shingles.

1. Equal sets fall into one class; classes go on by one row each.
2. In hash order, partners share at least ``slack`` shingles among their first n - T + slack; only
   these enter the distributed lists.  Lists of one document, and documents with fewer than
   ``slack`` entries in lists of several, drop out.
3. As DivideSkip does, short lists are merged and long ones (over ``LONG``) set aside: a pair is a
   candidate if the short lists name it as often as the slack less what the long lists could add.
   Documents for which that is nothing are tied to the first document of each of their long lists.
   Components of the candidate graph then hold every link.
4. Sets of the remaining documents are worked out again from their texts and go to cells: a
   component each, or, where it has over ``CELL`` documents, blocks of documents of near size.  In
   a large component all sets are first compared with that of one leader; documents linked with it
   are one class, and only the others search.
5. In a cell every document searches the inverted lists of the cell: the short lists are merged
   (a sort of their concatenation, whose runs are sorted already), documents that reach T less the
   number of long lists are kept, and the long lists are probed for them by binary search.  The
   overlaps are exact.  Links inside a component that is already known are not counted again.

Hashes of shingles have 64 bits; no link is lost, and a false one needs collisions within a pair.

Defined results: a null text, or one without words, has an empty set and is linked with nothing.
Null ids are documents; a component's id is its smallest id that is not null.  Rows of one id are
documents each.  Repeated rows are equal sets.  An empty table gives no row.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import session_of, small_join, stored
from ledgerlens.llm.graph import components
from ledgerlens.llm.segments import Codes

WORDS, PERCENT = 4, 85
#: Documents of a long list at least, less one.
LONG = 20
#: Documents of a cell, and of each of its two sides in a large component.
CELL, BLOCK = 1000, 500
#: Share of a set that is slack.
SLACK = 10
#: Distinct words that a worker remembers.
REMEMBERED = 200_000
#: Ids that may be broadcast.
IDS = 200_000
#: Work of binary search against merging, of the DivideSkip heuristic.
MU = 0.0085
SETS = "th long, doc_id long, n long, fa long, fb long"
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]


def mixed(h: np.ndarray, by: np.uint64) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * by
    return h ^ (h >> np.uint64(29))


class Shingler:
    """Sets of shingle hashes of texts."""

    def __init__(self, words: int):
        self.words = words
        self.clear()

    def clear(self) -> None:
        self.known, self.hashes = Codes(), np.zeros(0, np.uint64)

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """Sorted distinct hashes of each text."""
        if len(self.known) > REMEMBERED:
            self.clear()
        out, known = [], self.known
        split = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
        codes = [np.fromiter(map(known.__getitem__, w), np.int64, len(w)) for w in split]
        if len(known) > len(self.hashes):
            new = np.empty(len(known) - len(self.hashes), object)
            new[:] = list(known)[len(self.hashes) :]
            self.hashes = np.concatenate([self.hashes, pd.util.hash_array(new, categorize=False)])
        for c in codes:
            h, k = self.hashes[c], min(self.words, len(c))
            joined = np.full(max(len(c) - k + 1, 0) if k else 0, k, np.uint64)
            for i in range(k):
                joined = joined * ODD[0] + h[i : i + len(joined)]
            out.append(np.unique(mixed(joined, ODD[1])))
        return out


def needed(n: int, percent: int = PERCENT) -> int:
    """T: shingles that a partner shares at least."""
    return -(-percent * n // 100)


def slack(n: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(n / SLACK)).cast("long")


def fingerprints(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Two sums over a set that name it."""
    return [tuple(int(mixed(s, o).sum(dtype=np.uint64).astype(np.int64)) for o in ODD[1:]) for s in sets]


def _rows(b: pa.RecordBatch, sets: list[np.ndarray], lists: list[np.ndarray]) -> pa.RecordBatch:
    fa, fb = zip(*fingerprints(sets), strict=True)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    flat = np.concatenate(lists).view(np.int64)
    columns = [b["th"], b["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array(fa, pa.int64()), pa.array(fb, pa.int64())]
    return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["th", "doc_id", "n", "fa", "fb", "s"])


def shingled(docs: DataFrame, words: int, percent: int, whole: bool) -> DataFrame:
    """(th, doc_id, n, fa, fb, s): a hash of the text, the size of the set, its fingerprint, and
    its first hashes, or the ``whole`` set."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for b in batches:
            sets = shingler.sets(b["text"].to_pylist())
            lists = sets if whole else [s[: len(s) - needed(len(s), percent) + max(1, len(s) // SLACK)] for s in sets]
            yield _rows(b, sets, lists)

    return docs.select("th", "doc_id", "text").mapInArrow(rows, f"{SETS}, s array<long>")


def counted(entries: DataFrame) -> DataFrame:
    """Entries (h, node, n) of lists of several documents, of documents that have enough of them,
    with the length of the list and ``long``, the document's entries in long lists."""
    for _ in range(2):
        lists = entries.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1")
        entries = stored(entries.drop("df").join(lists, "h"), "join-lists")
        docs = entries.groupBy("node").agg(F.count("*").alias("c"), F.first("n").alias("size"), F.count_if(F.col("df") > LONG).alias("long"))
        docs = docs.filter(F.col("c") >= slack(F.col("size"))).select("node", "long")
        entries = entries.drop("long").join(docs, "node")
    return stored(entries, "join-entries")


def candidates(entries: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) of the candidate graph."""
    one = F.struct("node", "n", "long")
    short = entries.filter(F.col("df") <= LONG).groupBy("h").agg(F.array_sort(F.collect_list(one)).alias("docs"))  # at most LONG
    first = short.select(F.posexplode("docs").alias("i", "x"), "docs")
    pairs = first.select("x", F.explode(F.slice("docs", F.col("i") + 2, LONG)).alias("y"))
    near = percent * F.greatest("x.n", "y.n") <= 100 * F.least("x.n", "y.n")
    least = slack(F.least("x.n", "y.n")) - F.least("x.long", "y.long")
    short_pairs = (
        pairs.filter(near).groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        .agg(F.count("*").alias("c"), F.first(least).alias("least")).filter("c >= least").select("a", "b")
    )
    heavy = entries.filter((F.col("df") > LONG) & (F.col("long") >= slack(F.floor(F.col("n") * percent / 100))))
    anchors = heavy.groupBy("h").agg(F.min("node").alias("b"))
    tied = heavy.select("h", F.col("node").alias("a")).join(anchors, "h").select("a", "b")
    return short_pairs.union(tied).filter("a <> b").distinct()


class Lists:
    """Inverted lists of a cell, and the search for documents of T occurrences."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        doc = np.repeat(np.arange(len(sets)), self.sizes)
        shingles, self.of = np.unique(np.concatenate(sets), return_inverse=True)
        order = np.argsort(self.of, kind="stable")
        self.docs = doc[order]
        self.lengths = np.bincount(self.of, minlength=len(shingles))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.keys = self.of[order] * len(sets) + self.docs  # (list, document), sorted
        self.ends = np.cumsum(self.sizes)

    def search(self, x: int, t: int, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents with at least ``t`` shingles of x that ``skip`` does not mark, and how many."""
        lists = self.of[self.ends[x] - self.sizes[x] : self.ends[x]]
        lists = lists[np.argsort(self.lengths[lists], kind="stable")]
        longest = max(2, int(self.lengths[lists[-1]]))
        n_long = min(t - 1, int(t / (MU * np.log2(longest) + 1)))
        short, long_ = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
        runs = [self.docs[self.starts[s] : self.starts[s] + self.lengths[s]] for s in short]
        if sum(map(len, runs)) <= 64:
            merged = np.fromiter(heapq.merge(*map(np.ndarray.tolist, runs)), np.int64)
        else:
            merged = np.sort(np.concatenate(runs), kind="stable")
        found, count = np.unique(merged, return_counts=True)
        kept = (count >= t - n_long) & ~skip[found]
        found, count = found[kept], count[kept]
        if len(found) and n_long:
            probes = (long_[:, None] * len(self.sizes) + found).ravel()
            at = np.minimum(np.searchsorted(self.keys, probes), len(self.keys) - 1)
            count = count + (self.keys[at] == probes).reshape(n_long, -1).sum(axis=0)
        return found[count >= t], count[count >= t]


def links(sets: list[np.ndarray], asks: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join the documents of a cell into its components; ``asks`` marks who searches."""
    index = Lists(sets)
    component = np.arange(len(sets))
    out = []
    for x in np.flatnonzero(asks):
        found, shared = index.search(x, needed(len(sets[x]), percent), component == component[x])
        union = index.sizes[x] + index.sizes[found] - shared
        for y in found[100 * shared >= percent * union]:
            if component[y] != component[x]:
                component[component == component[y]] = component[x]
                out.append((x, y))
    return out


def linked(cells: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of nodes; cells has (cell, node, asks, s)."""

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["node", "asks"], ascending=[True, False]).drop_duplicates("node")
        sets = [np.asarray(s, np.int64) for s in pdf["s"]]
        node = pdf["node"].to_numpy()
        found = links(sets, pdf["asks"].to_numpy(), percent) if len(sets) > 1 else []
        return pd.DataFrame([(node[x], node[y]) for x, y in found], columns=["a", "b"], dtype="int64")

    return cells.groupBy("cell").applyInPandas(find, "a long, b long")


def large_cells(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links with the leaders of large components, and the cells of who is not linked with them."""
    leader = sets.groupBy("component").agg(F.min(F.struct("node", "s")).alias("leader"))
    led = small_join(sets, stored(leader, "join-leaders"), ["component"])
    shared = F.size(F.array_intersect("s", "leader.s"))
    is_linked = 100 * shared >= percent * (F.col("n") + F.size("leader.s") - shared)
    led = stored(led.withColumn("asks", ~is_linked).withColumn("lead", F.col("leader.node")).drop("leader"), "join-led")
    found = led.filter("NOT asks").select(F.col("node").alias("a"), F.col("lead").alias("b"))

    # Documents of a band of sizes meet those of the same and the neighbouring bands.
    led = led.withColumn("band", F.floor(F.log("n") / F.log(F.lit(100 / percent))).cast("int"))
    side = lambda of, name: of.groupBy("component", "band").agg(F.ceil(F.count("*") / BLOCK).alias(name))
    blocks, asking = side(led, "blocks"), side(led.filter("asks"), "asking")
    block = lambda m: F.pmod(F.xxhash64("node"), F.col(m))
    bands = F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))
    cell = lambda q, i, b, j: F.concat_ws("/", "component", q, i, b, j).alias("cell")
    keep = ["node", "s"]

    q = small_join(led.filter("asks"), stored(asking, "join-asking"), ["component", "band"]).withColumn("i", block("asking"))
    q = q.select("component", F.col("band").alias("q_band"), "i", *keep, bands.alias("band"))
    q = small_join(q, stored(blocks, "join-blocks"), ["component", "band"])
    q = q.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("j"))
    q = q.select(cell("q_band", "i", "band", "j"), *keep, F.lit(True).alias("asks"))

    c = small_join(led, stored(blocks, "join-blocks"), ["component", "band"]).withColumn("j", block("blocks"))
    c = c.select("component", F.col("band").alias("c_band"), "j", *keep, bands.alias("band"))
    c = small_join(c, stored(asking, "join-asking"), ["component", "band"])
    c = c.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("asking") - 1)).alias("i"))
    c = c.select(cell("band", "i", "c_band", "j"), *keep, F.lit(False).alias("asks"))
    return found, q.union(c)


def joined(docs: DataFrame, text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(th, doc_id, n_shingles, cluster, component_id): one row for each document.

    ``th`` is xxhash64 of the text; ``cluster`` names the component, also where ids are null.
    """
    session_of(docs)
    docs = docs.select(F.xxhash64(text).alias("th"), F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = stored(shingled(docs, words, percent, False).withColumn("row", F.monotonically_increasing_id()), "join-rows")
    name = ["fa", "fb", "n"]
    classes = rows.filter("n > 0").groupBy(*name).agg(F.min("row").alias("node"), F.min("doc_id").alias("least_id"))
    classes = stored(classes, "join-classes")

    reps = rows.join(classes.select(F.col("node").alias("row")), "row", "left_semi")
    entries = reps.select(F.explode("s").alias("h"), F.col("row").alias("node"), "n")
    edges = candidates(counted(entries), percent)
    members = stored(components(edges, "join-candidates"), "join-members")

    # Whole sets again, of the first document of each class that has candidates.
    of_class = stored(members.join(classes, "node"), "join-of-class")
    ids = of_class.select(F.coalesce("least_id", F.lit(0)).alias("id")).distinct()
    again = small_join(docs.withColumn("id", F.coalesce("doc_id", F.lit(0))), stored(ids, "join-ids"), ["id"], rows=IDS)
    sets = shingled(again, words, percent, True).join(of_class.drop("least_id"), name)
    sets = stored(sets.select("node", "component", "n", "s").dropDuplicates(["node"]), "join-sets")

    sizes = sets.groupBy("component").agg(F.count("*").alias("size"))
    large = stored(sizes.filter(F.col("size") > CELL).select("component"), "join-large")
    small = sets.join(large, "component", "left_anti")
    cells = small.select(F.col("component").cast("string").alias("cell"), "node", "s", F.lit(True).alias("asks"))
    with_leader, more = large_cells(small_join(sets, large, ["component"]), percent)
    found = stored(linked(cells.unionByName(more), percent).union(with_leader), "join-links")

    final = components(found, "join-final").withColumnRenamed("component", "cluster")
    classes = classes.join(final, "node", "left").withColumn("cluster", F.coalesce("cluster", "node"))
    least = classes.groupBy("cluster").agg(F.min("least_id").alias("component_id"))
    classes = stored(classes.join(least, "cluster").select(*name, "cluster", "component_id"), "join-result")
    own = rows.select("th", "doc_id", *name, "row").join(classes, name, "left")
    alone = F.col("n") == 0
    return own.select(
        "th", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("cluster", "row").alias("cluster"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one document of each component: that of the smallest id, of the smallest hash
    of its text among such, and one of equal rows."""
    rows = joined(docs, text)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("first")
    kept = stored(rows.groupBy("cluster").agg(first).select("first.none", F.coalesce("first.doc_id", F.lit(0)).alias("id"), "first.th").distinct(), "join-kept")
    keyed = docs.select(
        F.struct(*docs.columns).alias("doc"), F.col("doc_id").isNull().alias("none"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.xxhash64(text).alias("th"),
    )
    key = ["none", "id", "th"]
    return keyed.join(kept, key, "left_semi").dropDuplicates(key).select("doc.*")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 3), ' ') AS k
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS i FROM w WHERE len(words) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM sh a JOIN sh b ON a.k = b.k AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))
),
reach AS (
  SELECT doc_id, doc_id AS other FROM w
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other
)
SELECT w.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.other) AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN reach r ON r.doc_id = w.doc_id
GROUP BY w.doc_id
"""
