"""Token ids in files of byte-aligned codes of variable length.

Ids are replaced by their rank in the corpus by falling frequency, so that the most frequent 256
take one byte.  A block of documents holds a control stream of two bits for each id (bytes less
one) apart from the data stream; numpy decodes both by looking up the control byte in a table.

A folder of token files holds:

* ``ranks``: one row (rank, id, count) for each id that occurs;
* ``blocks``: rows (part, block, start, doc_ids, lengths, control, data), Parquet as container.
  Parts ascend with doc_id, blocks with their number within a part; ``start`` counts the ids that
  precede a block within its part.

Documents are in ascending order of doc_id, null ids first; equal ids are ordered by their codes,
so reruns agree.  A null or empty text holds the end id alone.  An empty table writes no block
and reads back as no row.  Other columns of the input are not written.
"""

from __future__ import annotations

import codecs
import os
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import session_of, small_join
from ledgerlens.llm.segments import SegmentCache, ranges
from ledgerlens.session import work_folder

#: Text bytes that one part of the files takes about.
PART_BYTES = 64 << 20
#: Distinct segments, and stems, that a worker remembers.
STEMS = 800_000
#: Segments that the library gets as one text.
LINES = 200
#: Bytes of rows that a worker takes at once; the more, the fewer segments are looked up again.
TAKEN = 8 << 20
#: A word of letters up to U+024F, perhaps a mark.
LATIN = r"^[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]+[.,]?$"
#: White space at an end, next to other white space, or that is no plain space or line break.
ODD_SPACE = (
    r"^[ \n]|[ \n]$|[ \n][ \n]|[\t\r\v\f\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
CODED = "doc_id long, n_tokens long, codes binary"
BLOCKS = "part int, block long, start long, doc_ids array<long>, lengths array<long>, control binary, data binary"
#: Bytes that each of the four ids of a control byte takes, and which of four bytes are there.
WIDTHS = 1 + ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3)
PRESENT = np.arange(4) < WIDTHS[:, :, None]
PRESENT_IN_TWO = np.ascontiguousarray(PRESENT[:, :, :2])


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data stream of unsigned 32-bit values."""
    values = values.astype("<u4")
    extra = (values > 0xFF).astype(np.uint8)
    most = int(values.max(initial=0))
    if most > 0xFFFF:
        extra += (values > 0xFFFF).astype(np.uint8) + (values > 0xFFFFFF)
    fours = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    fours[: len(values)] = extra
    control = (fours.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    lanes, kind = (4, "<u4") if most > 0xFFFF else (2, "<u2")
    there = np.arange(lanes, dtype=np.uint8) <= extra[:, None]
    return control.tobytes(), values.astype(kind).view(np.uint8).reshape(-1, lanes)[there].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    control = np.frombuffer(control, np.uint8)
    wide = (control & 0b10101010).any()  # of more than two bytes
    lanes, kind, table = (4, "<u4", PRESENT) if wide else (2, "<u2", PRESENT_IN_TWO)
    there = table[control].reshape(-1, lanes)[:n]
    out = np.zeros((n, lanes), np.uint8)
    out[there] = np.frombuffer(data, np.uint8)
    return out.view(kind).ravel().astype("<u4")


class ByteTokenizer:
    """The tokenizers library, asked for distinct stems only.

    A byte-level tokenizer cuts before a space that a non-space follows, and around a line break
    between non-spaces; texts with other neighbouring white space, or with the text of an added
    token, go to the library whole.  A segment is a word after a space, written without it, or
    the first word of a line, written with the break; a text is taken as a line.  A word of Latin
    letters after a space, perhaps before a mark, is a stem and a mark, each a piece that the model
    of the library merges by itself; other segments take the library's whole path.  New segments of
    a kind go to the library some hundred at a time; one begins where an id begins with its space
    or break.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.lib = Tokenizer.from_file(path)
        pre = self.lib.pre_tokenizer
        self.added = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.pieces = Tokenizer(self.lib.model)
        self.pieces.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        moved = [b for b in range(256) if b not in kept]
        letters = {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(moved)}  # how a byte-level model writes bytes
        self.space, self.line = letters[ord(" ")], letters[ord("\n")]
        self.letters = "".join(letters[b] for b in range(256)).replace(self.space, " ").replace(letters[0], self.space)
        vocab = self.lib.get_vocab()
        self.begins = {c: np.zeros(max(vocab.values()) + 1, bool) for c in (self.space, self.line)}
        for c, begins in self.begins.items():
            begins[[i for t, i in vocab.items() if t[:1] == c]] = True
        self.plain = (
            self.lib.normalizer is None and type(pre).__name__ == "ByteLevel" and not pre.add_prefix_space
            and {self.space, self.line, *".,"} <= vocab.keys() and not any(" " in t or "\n" in t for t in self.added)
        )
        self.marks = {m: vocab.get(m, -1) for m in ".,"}
        self.stems = SegmentCache(self.encode_stems, STEMS)
        self.cache = SegmentCache(self.encode_segments, STEMS)

    def separable(self, texts: pa.Array) -> np.ndarray:
        """Which texts fall into segments; the library gets the others whole."""
        if not self.plain:
            return np.zeros(len(texts), bool)
        odd = pc.match_substring_regex(texts, ODD_SPACE)
        for t in self.added:
            odd = pc.or_(odd, pc.match_substring(texts, t))
        return ~booleans(odd)

    def encode_segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words = pa.array(segments, pa.string())
        latin, first = booleans(pc.match_substring_regex(words, LATIN)), booleans(pc.starts_with(words, "\n"))
        lengths, found = np.zeros(len(words), np.int64), []
        for kind, encode in ((latin, self.encode_latin), (first, self.encode_first), (~latin & ~first, self.encode_others)):
            part, lengths[kind] = encode(words.filter(pa.array(kind)))
            found.append((kind, part))
        starts = np.cumsum(lengths) - lengths
        flat = np.zeros(lengths.sum(), np.int32)
        for kind, part in found:
            flat[ranges(starts[kind], lengths[kind])] = part
        return flat, lengths

    def encode_latin(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        stems = pc.utf8_rtrim(words, ".,").dictionary_encode()
        flat, lengths = self.stems.encode_distinct(strings(stems.dictionary), stems.indices.to_numpy(), np.ones(len(words), np.int64))
        mark = np.full(len(words), -1)
        for m, i in self.marks.items():
            mark[booleans(pc.ends_with(words, m))] = i
        marked = mark >= 0
        return np.insert(flat, np.cumsum(lengths)[marked], mark[marked]), lengths + marked

    def encode_stems(self, stems: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Stems after a space, in the letters of the model: a NUL stands for that space, a space parts them."""
        texts = [codecs.charmap_decode(f"\0{' \0'.join(x)}".encode(), "strict", self.letters)[0] for x in hundreds(stems)]
        return self.cut(self.pieces, texts, self.space)

    def encode_first(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self.cut(self.lib, ["".join(x) for x in hundreds(strings(words))], self.line)

    def encode_others(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self.cut(self.lib, [" " + " ".join(x) for x in hundreds(strings(words))], self.space)

    def cut(self, lib, texts: list[str], letter: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, and the number of them from each that begins with the letter to the next."""
        ids = [e.ids for e in lib.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(ids), np.int32)
        return flat, np.diff(np.flatnonzero(self.begins[letter][flat]), append=len(flat))

    def encode(self, texts: pa.Array | list[str | None]) -> list[np.ndarray]:
        """Ids of each text.  Arrow cuts the texts and finds the distinct segments of a batch, which
        alone become Python strings."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        separable = self.separable(texts)
        lines = pc.replace_substring(texts.filter(pa.array(separable)), "\n", " \n")
        words = pc.split_pattern(pc.binary_join_element_wise("\n", lines, ""), " ")
        distinct = words.flatten().dictionary_encode()
        sizes = np.diff(words.offsets.to_numpy()).astype(np.int64)
        flat, counts = self.cache.encode_distinct(strings(distinct.dictionary), distinct.indices.to_numpy(), sizes)
        cut = iter(np.split(flat, np.cumsum(counts))[:-1])
        # Without the added break.
        return [next(cut)[1:] if s else np.array(self.lib.encode(t.as_py(), add_special_tokens=False).ids, np.int32) for s, t in zip(separable, texts, strict=True)]


def booleans(array: pa.Array) -> np.ndarray:
    return array.to_numpy(zero_copy_only=False)


def strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()  # to_pylist takes ten times as long


def hundreds(segments: list[str]) -> Iterator[list[str]]:
    return (segments[i : i + LINES] for i in range(0, len(segments), LINES))


@cache
def tokenizer(path: str) -> ByteTokenizer:
    return ByteTokenizer(path)


def id_type(path: str, end_id: int) -> str:
    """Two bytes where all ids fit, else four."""
    return "<u2" if max(end_id + 1, tokenizer(path).lib.get_vocab_size()) <= 1 << 16 else "<u4"


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in the same order, in batches of ``TAKEN`` bytes or just over."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= TAKEN:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def tokenized(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(doc_id, n_tokens, codes): ids as integers of ``id_type``, end id included."""
    session_of(docs)
    kind = id_type(path, end_id)

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gathered(batches):
            found = [np.append(x, end_id).astype(kind) for x in tokenizer(path).encode(b["text"])]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array([len(x) for x in found], pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())],
                ["doc_id", "n_tokens", "codes"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(ids, CODED)


def frequencies(tokens: DataFrame, kind: str) -> DataFrame:
    """(rank, id, count) by falling count, then id; at most one row for each id there is."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            more = np.bincount(np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in b["codes"]]))
            if len(more) > len(total):
                total, more = more, total
            total[: len(more)] += more
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(total[there])], ["id", "count"])

    counts = tokens.select("codes").mapInArrow(counted, "id long, count long").groupBy("id").agg(F.sum("count").alias("count"))
    order = Window.orderBy(F.desc("count"), "id")
    return counts.select((F.row_number().over(order) - 1).alias("rank"), "id", "count")


def write(docs: DataFrame, path: str, end_id: int, folder: str) -> None:
    """Tokenise ``docs`` (doc_id, text) and write token files to a new folder."""
    spark = session_of(docs)
    coded = work_folder(spark, "tokens")
    tokenized(docs, path, end_id).write.option("compression", "zstd").parquet(coded)
    tokens = spark.read.schema(CODED).parquet(coded)
    kind = id_type(path, end_id)
    frequencies(tokens, kind).coalesce(1).write.parquet(f"{folder}/ranks")
    ids = spark.read.parquet(f"{folder}/ranks").select("rank", "id").toPandas()  # bounded by the vocabulary
    rank_of = np.zeros(int(ids["id"].max() + 1) if len(ids) else 1, np.uint32)
    rank_of[ids["id"]] = ids["rank"]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        for k, b in enumerate(batches):
            flat = np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in b["codes"]])
            control, data = pack(rank_of[flat])
            row = {"part": part, "block": k, "start": start, "doc_ids": b["doc_id"].to_pylist(),
                   "lengths": b["n_tokens"].to_pylist(), "control": control, "data": data}
            start += len(flat)
            yield pa.RecordBatch.from_pylist([row], BLOCK_ARROW)

    size = tokens.agg(F.sum("n_tokens")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size * 4 // PART_BYTES)
    ordered = tokens.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "n_tokens")
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "n_tokens", "codes")
    ordered.mapInArrow(blocks, BLOCKS).write.option("compression", "zstd").parquet(f"{folder}/blocks")


BLOCK_ARROW = pa.schema(
    [("part", pa.int32()), ("block", pa.int64()), ("start", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
     ("lengths", pa.list_(pa.int64())), ("control", pa.binary()), ("data", pa.binary())]
)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, ids): each document of the files and the number of ids before it; ids as
    little-endian unsigned 32-bit integers."""
    files = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    by_part = files.select("part", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    sums = by_part.groupBy("part").agg(F.sum("n").alias("n"))  # a row for each part
    before = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    table = spark.read.parquet(f"{folder}/ranks").select("rank", "id").toPandas()  # bounded by the vocabulary
    id_of = np.zeros(max(1, len(table)), "<u4")
    id_of[table["rank"]] = table["id"]

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                ids = id_of[unpack(row["control"], row["data"], int(lengths.sum()))]
                ends = np.cumsum(lengths)
                starts = ends - lengths
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["start"] + row["before"]),
                     pa.array([ids[a:z].tobytes() for a, z in zip(starts, ends, strict=True)], pa.binary())],
                    ["doc_id", "start", "ids"],
                )

    session_of(files).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 8)  # of whole blocks
    return small_join(files, before, ["part"]).select("before", *files.columns).mapInArrow(documents, "doc_id long, start long, ids binary")


def digest(docs: DataFrame, path: str, end_id: int, folder: str) -> DataFrame:
    """Write the files, read them back, and give each document's place, length and checksum."""
    write(docs, path, end_id, folder)
    back = read(docs.sparkSession, folder)
    return back.select(
        "doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
