"""Quality of texts by the votes of their nearest labelled neighbours in latent-semantic space.

1. A text becomes counts of its words, of the shapes of its tokens (``THE!!`` has the shape
   ``A!``) and of tokens that repeat the one before, which count as that alone, hashed to ``BUCKETS`` places, damped by a logarithm, and weighted by how few of *all*
   texts hold them; these frequencies come from a pass over the whole table.
2. A truncated singular value decomposition of the labelled texts, by subspace iteration, gives
   ``RANK`` latent directions.  Labelled texts, as unit vectors along them, are broadcast with their
   labels: at most ``LABELLED`` of them, those first by a hash of the id.
3. Every text is projected, and its cosines with all labelled vectors are computed exactly, block
   by block.  Its ``NEIGHBOURS`` nearest, and any as near as the last of these, vote for their label
   with their similarity as weight.

Only the labelled sample that is fitted and broadcast is bounded: by ``LABELLED`` texts, and by
``ENTRIES`` counts that reach the driver, so that a sample of very long texts holds fewer of them.
Whole texts are counted and scored, a few million characters at a time.

Defined results: a null or empty text has no features, its score is the share of label 1 among the
labelled texts, and so is that of a text which no neighbour resembles; without any label the score is 0.
Labels of rows held out, null labels and null ids teach nothing; several labels of one id are
averaged, and of several texts of one id the last in order teaches.  Repeated rows are scored alike.  Columns of other names play no part.  An empty table
gives no row.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ledgerlens.llm.common import CHARACTERS, held_out, stored

#: Labelled texts that vote, and counts of them that the decomposition takes.
LABELLED, ENTRIES = 4096, 8_000_000
BUCKETS = 1 << 15
RANK, EXTRA, ROUNDS = 64, 16, 4
NEIGHBOURS = 25
THRESHOLD = 0.3
#: Texts whose cosines are taken together, and entries about which are multiplied together, so few that caches hold them.
BLOCK, STEP = 512, 1 << 10

#: Place of the tokens that repeat the one before.
AGAIN = zlib.crc32(b"again") % BUCKETS
PUNCTUATION = bytes([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])
#: What crc32 has of a word before its first character.
WORD = zlib.crc32(b"word ")
#: Kinds of code points, as far as they were met.
UNKNOWN = 0xFFFFFFFF
KINDS = np.full(sys.maxunicode + 1, UNKNOWN, np.uint32)


def kind(c: str) -> str:
    """``A``, ``a`` and ``9`` for upper case, lower case and digits; others as they are."""
    return "A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c


def shape(lines: str) -> str:
    """Kinds of the characters of each token, each run as one; tokens are lines."""
    points = np.frombuffer(lines.encode("utf-32-le"), np.uint32)
    for p in np.unique(points[KINDS[points] == UNKNOWN]).tolist():
        KINDS[p] = ord(kind(chr(p)))
    kinds = KINDS[points]
    first = np.ones(len(kinds), bool)
    first[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == ord("\n"))
    return kinds[first].tobytes().decode("utf-32-le")


def places_of(lines: str) -> np.ndarray:
    """(tokens, 2): places of the word and of the shape of each token; a token without a word has its
    shape twice.  Tokens are lines: none holds white space, and no character's case depends on those beyond it."""
    shapes = pc.split_pattern(pa.array([shape(lines)]), "\n").flatten().dictionary_encode()
    distinct = [zlib.crc32(f"shape {x}".encode()) % BUCKETS for x in shapes.dictionary.to_pylist()]
    form = np.array(distinct, np.int64)[shapes.indices.to_numpy()]
    words = [w.strip(PUNCTUATION) for w in lines.lower().encode().split(b"\n")]
    word = np.fromiter(map(zlib.crc32, words, repeat(WORD)), np.int64, len(words)) % BUCKETS
    return np.stack([np.where(np.array(list(map(bool, words))), word, form), form], axis=1)


def buckets_of(token: str) -> tuple[int, int]:
    """Places of the word and of the shape of one token."""
    word, form = places_of(token)[0].tolist()
    return word, form


@dataclass
class Counts:
    """Sparse rows: entry ``e`` of row ``row[e]`` has ``count[e]`` in place ``at[e]``."""

    n: int
    row: np.ndarray
    at: np.ndarray
    count: np.ndarray


def parts_of(texts: pa.Array) -> Iterator[pa.Array]:
    """Texts in order, nulls as empty ones, at most ``CHARACTERS`` at a time or a single one."""
    texts = texts.fill_null("")
    start, size = 0, 0
    for k, n in enumerate(pc.utf8_length(texts).to_numpy().tolist()):
        if k > start and size + n > CHARACTERS:
            yield texts.slice(start, k - start)
            start, size = k, 0
        size += n
    if len(texts) > start:
        yield texts.slice(start)


def counted(texts: pa.Array) -> Counts:
    """Features of texts, none null; each distinct token is hashed once, and all of them by a few calls."""
    split = pc.utf8_split_whitespace(texts)
    tokens = split.flatten().dictionary_encode()
    codes, row = tokens.indices.to_numpy(), np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
    blank = pc.index(tokens.dictionary, "").as_py()  # before and after the white space at the ends of a text
    if blank >= 0:
        codes, row = codes[codes != blank], row[codes != blank]
    distinct = tokens.dictionary.cast(pa.string())  # Spark may hand over large ones
    lines = pc.binary_join(pa.ListArray.from_arrays([0, len(distinct)], distinct), "\n")[0].as_py()
    again = np.zeros(len(codes), bool)
    again[1:] = (codes[1:] == codes[:-1]) & (row[1:] == row[:-1])
    words = (row[~again, None] * BUCKETS + places_of(lines)[codes[~again]]).ravel()
    keys, count = np.unique(np.concatenate([words, row[again] * BUCKETS + AGAIN]), return_counts=True)
    return Counts(len(texts), keys // BUCKETS, keys % BUCKETS, count)


def frequencies(docs: DataFrame, text: str) -> tuple[int, np.ndarray]:
    """Number of texts, and for each place the number of texts that hold it."""

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(BUCKETS + 1, np.int64)
        for b in batches:
            for part in parts_of(b.column(0)):
                n[:-1] += np.bincount(counted(part).at, minlength=BUCKETS)
                n[-1] += len(part)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["at", "n"])

    found = docs.select(text).mapInArrow(held, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(BUCKETS + 1, np.int64)
    for r in found:  # at most ``BUCKETS`` rows
        n[r["at"]] = r["n"]
    return int(n[-1]), n[:-1]


def weighted(counts: Counts, idf: np.ndarray) -> np.ndarray:
    """Weights of the entries; those of a row have the length one."""
    w = (1 + np.log(counts.count)) * idf[counts.at]
    return w / np.sqrt(np.bincount(counts.row, w * w, counts.n))[counts.row]


def times(row: np.ndarray, at: np.ndarray, w: np.ndarray, dense: np.ndarray, n: int) -> np.ndarray:
    """Rows of the sparse matrix (row, at, w), sorted by row, times a dense one; some whole rows at a time."""
    out = np.zeros((n, dense.shape[1]))
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    ends = np.append(starts[1:], len(row))
    first = np.unique(starts // STEP, return_index=True)[1]
    for a, z in zip(first, [*first[1:], len(starts)]):
        e = slice(starts[a], ends[z - 1])
        out[row[starts[a:z]]] = np.add.reduceat(dense[at[e]] * w[e, None], starts[a:z] - starts[a])
    return out


def directions(counts: Counts, w: np.ndarray, rank: int = RANK) -> np.ndarray:
    """(BUCKETS, rank): leading right singular vectors of the weighted rows, by subspace iteration."""
    order = np.lexsort((counts.row, counts.at))
    row, at, turned = counts.row[order], counts.at[order], w[order]
    basis = np.random.default_rng(7).normal(size=(BUCKETS, min(rank + EXTRA, counts.n)))
    for _ in range(ROUNDS):
        left, _ = np.linalg.qr(times(counts.row, counts.at, w, basis, counts.n))
        basis, _ = np.linalg.qr(times(at, row, turned, left, BUCKETS))
    left = times(counts.row, counts.at, w, basis, counts.n)
    return basis @ np.linalg.svd(left, full_matrices=False)[2].T[:, :rank]


def units(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows * rows).sum(1, keepdims=True))
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 1e-12)


@dataclass
class Model:
    """Weights of places, latent directions, and labelled unit vectors with labels."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @property
    def prior(self) -> float:
        return float(self.labels.mean()) if len(self.labels) else 0.0

    def latent(self, counts: Counts) -> np.ndarray:
        return units(times(counts.row, counts.at, weighted(counts, self.idf), self.axes, counts.n))

    def votes(self, rows: np.ndarray) -> np.ndarray:
        """Scores of unit vectors."""
        out = np.full(len(rows), self.prior)
        k = min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(rows) if k else 0, BLOCK):
            cosine = rows[at : at + BLOCK] @ self.vectors.T
            last = np.partition(cosine, -k, axis=1)[:, -k, None]
            weight = np.where(cosine >= last, np.maximum(cosine, 0), 0)
            total = weight.sum(1)
            np.divide(weight @ self.labels, total, out=out[at : at + BLOCK], where=total > 0)
        return np.clip(out, 0, 1)


def train(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", text: str = "text") -> Model:
    """Fit on ``docs`` and ``labels`` (doc_id, label) where ``learn``, a condition on doc_id."""
    docs = docs.select("doc_id", F.col(text).alias("text"))
    n, held = frequencies(docs, "text")
    idf = np.log((1 + n) / (1 + held)) + 1
    known = labels.filter(learn & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known.groupBy("doc_id").agg(F.avg(label).alias("label"))
    # Ids alone are put in order; their texts are fetched after, one for each.
    ids = known.join(docs.select("doc_id").distinct(), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
    chosen = docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.max("text").alias("text"))

    def packed_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(len(b)):
                c = counted(b.column(2).slice(k, 1).fill_null(""))
                packed = [pa.array([x.astype(np.int32).tobytes()], pa.binary()) for x in (c.at, c.count)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(k, 1), b.column(1).slice(k, 1), pa.array([len(c.at)]), *packed], ["doc_id", "label", "size", "at", "n"])

    schema = StructType([chosen.schema["doc_id"], StructField("label", DoubleType()), *StructType.fromDDL("size long, at binary, n binary").fields])
    sample = stored(chosen.mapInArrow(packed_counts, schema), "quality-sample")
    before = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    sizes = sample.select("doc_id", F.sum("size").over(before).alias("total"))  # at most ``LABELLED`` numbers
    kept = sizes.filter(F.col("total") <= ENTRIES).select("doc_id")
    rows = sorted(sample.join(F.broadcast(kept), "doc_id").select("doc_id", "label", "at", "n").collect(), key=lambda r: r["doc_id"])
    at, count = ([np.frombuffer(r[c], np.int32).astype(np.int64) for r in rows] for c in ("at", "n"))
    sample_labels = np.array([float(r["label"]) for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(a) for a in at])
    if not len(row):
        return Model(idf, np.zeros((BUCKETS, 1), np.float32), np.zeros((len(rows), 1)), sample_labels)
    counts = Counts(len(rows), row, np.concatenate(at), np.concatenate(count))
    axes = directions(counts, weighted(counts, idf)).astype(np.float32)
    model = Model(idf, axes, np.zeros((0, 0)), sample_labels)
    model.vectors = model.latent(counts)
    return model


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by ``LABELLED``, ``BUCKETS`` and ``RANK``

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shared.value.votes(shared.value.latent(counted(part))) for part in parts_of(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate([np.zeros(0), *found]))], ["doc_id", "score"])

    rows = docs.select("doc_id", F.col(text).alias("text"))
    out = StructType([rows.schema["doc_id"], StructField("score", DoubleType())])
    return rows.mapInArrow(score, out).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every document by labels that are not of the held-out fifth."""
    out = held_out("doc_id", 5, 0)
    model = train(docs.select("doc_id", "text"), labels.select("doc_id", "quality"), ~out)
    return scored(docs, model).select("doc_id", out.alias("held_out"), "score", "predicted")
