"""Spelling variants: words one edit apart, grouped under the form that is written far more often.

Words are near if they differ by one inserted, deleted or replaced code point.  They are found by
asymmetric q-chunks:

1. A word of L code points contributes two disjoint chunks, its first ``L div 2`` code points and
   the rest.  One edit touches one of them at most, so the other is left whole.
2. The other word, as long or one longer, contributes its positional grams of those two lengths.
   A chunk is joined with the grams within one place of where it starts itself: an edit behind
   the chunk leaves it in place, one before it shifts it by the difference of the lengths.  Grams
   elsewhere join nothing and are not written.
3. Pairs are verified by their distance.

Chunks that very many words share are not paired: what is left of a word, the stretch that holds
the edit, is cut into two chunks again, for as long as a chunk is shared by more than ``BUCKET``
pairs.  A stretch of one code point needs no cut, as its words are near each other.  So the work
follows the pairs there are, not the square of a group, and no word is left out.

A pair is counted for one chunk only: for the later one only if the earlier does not match.

Defined results: null words and counts take no part; rows of one word are added up.  A null text
has no words, a null id counts as empty text in the hash.  Texts and words of any length go: keys
are hashes of what surrounds the stretch, verified on the words.  On equal counts the form is the
first in code-point order.  An empty table gives no row.  Other columns of the input play no part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored

#: A letter run, lower-cased in A-Z only.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Code points and occurrences that a word has at least; one of ``SLIP`` runs loses a letter.
LEAST_LENGTH, LEAST_COUNT, SLIP = 6, 5, 199
#: A form occurs so many times as often as its variant, at least.
RATIO = 5
#: Pairs that a chunk may give before the stretch beside it is cut again.
BUCKET = 1024

KEY = ["len", "a", "b", "h"]


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, run) for every letter run of every whole text, lower-cased."""
    found = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(RUN), F.lit(0))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.explode(found).alias("run"))
    return rows.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))


def slipped(rows: DataFrame) -> DataFrame:
    """(word) of each run: one in ``SLIP``, by hash of id and run, loses the code point the hash names."""
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    at = (F.col("hash") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    rows = rows.withColumn("hash", F.crc32(name.cast("binary")))
    return rows.select(F.when(F.col("hash") % SLIP == 0, shorter).otherwise(F.col("run")).alias("word"))


def counted(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough; a task sends a word once."""
    long = words.filter(F.char_length("word") >= least_length)
    return long.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def _keys(rows: DataFrame, windows: Column) -> DataFrame:
    """A row for each window [a, b) of the chunk word's places; ``h`` hashes what is around it in
    ``word``, which has ``shift`` code points more."""
    cut = rows.withColumn("window", F.explode(windows)).select("word", "n", "len", "shift", F.col("window.a").alias("a"), F.col("window.b").alias("b"))
    before = F.substr("word", F.lit(1), F.col("a"))
    after = F.substr("word", F.col("b") + F.col("shift") + 1)
    return cut.withColumn("h", F.xxhash64("len", "a", "b", before, after))


def _halves(a: Column, b: Column) -> Column:
    """The edit lies in the later half, the earlier one being a chunk, or the other way round."""
    middle = ((a + b) / 2).cast("int")
    return F.array(F.struct(middle.alias("a"), b.alias("b")), F.struct(a.alias("a"), middle.alias("b")))


def _pairs(rows: DataFrame) -> DataFrame:
    """(word, other, other_n), both ways, of the near words that share a key."""
    c = rows.filter("shift = 0").select(*KEY, F.col("word").alias("word"), F.col("n").alias("word_n"))
    g = rows.select(*KEY, "shift", F.col("word").alias("other"), F.col("n").alias("other_n"))
    a, b = F.col("a"), F.col("b")
    around = (F.substr("word", F.lit(1), a) == F.substr("other", F.lit(1), a)) & (F.substr("word", b + 1) == F.substr("other", b + F.col("shift") + 1))
    # With the places before b alike too, the pair belongs to an earlier chunk.
    again = (b < F.col("len")) & (F.substr("word", F.lit(1), b) == F.substr("other", F.lit(1), b))
    near = (F.col("word") != F.col("other")) & around & ~again & (F.levenshtein("word", "other", 1) == 1)
    found = c.join(g, KEY).filter(near)
    # Words of one length meet both ways by themselves; a longer one is no chunk word here.
    both = F.array(
        F.struct("word", "other", "other_n"),
        F.struct(F.col("other").alias("word"), F.col("word").alias("other"), F.col("word_n").alias("other_n")),
    )
    found = found.withColumn("ways", F.when(F.col("shift") == 1, both).otherwise(F.slice(both, 1, 1)))
    return found.select(F.inline("ways"))


def near_pairs(words: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(word, other, other_n) for all words of (word, n) that are one edit apart, both ways."""
    # A word is a chunk word of its own length, and a gram word of it and of one less.
    roles = F.explode(F.array(F.lit(0), F.lit(1)))
    rows = words.withColumn("shift", roles).withColumn("len", F.char_length("word") - F.col("shift")).filter("len > 0")
    rows = stored(_keys(rows, _halves(F.lit(0), F.col("len"))), "spelling-chunks")
    found = []
    while True:
        size = rows.groupBy(*KEY).agg(F.count_if(F.col("shift") == 0).alias("chunks"), F.count("*").alias("grams"))
        shared = size.filter("chunks > 0 AND grams > 1")
        heavy = (F.col("chunks") * F.col("grams") > bucket) & (F.col("b") - F.col("a") > 1)
        rows = stored(rows.join(shared.withColumn("heavy", heavy).drop("chunks", "grams"), KEY), "spelling-shared")
        found.append(_pairs(rows.filter("NOT heavy")))
        hot = rows.filter("heavy")
        if hot.isEmpty():
            return reduce(DataFrame.unionByName, found)
        hot = hot.select("word", "n", "len", "shift", F.col("a").alias("from"), F.col("b").alias("to"))
        rows = stored(_keys(hot, _halves(F.col("from"), F.col("to"))), "spelling-chunks")


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form), each word once: forms are followed to the last.

    A round doubles the steps taken; counts grow ``RATIO``-fold at each step, so a few rounds do.
    """
    now = stored(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        then = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = now.join(then, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step = stored(step, "spelling-roots")
        if step.filter("moved").isEmpty():
            return step.drop("moved")
        now = step.drop("moved")


def variants(words: DataFrame, ratio: int = RATIO, bucket: int = BUCKET) -> DataFrame:
    """word, form, root, n, n_near, form_n for each word of (word, n).

    The form is the near word of largest n if that is at least ``ratio`` times the word's; the root
    is the last of the forms that follow, the word itself if it has none.
    """
    words = words.filter("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    words = stored(words, "spelling-words")
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))).alias("best")
    near = near_pairs(words, bucket).groupBy("word").agg(F.count("*").alias("n_near"), best)
    rows = words.join(near, "word", "left")
    taken = -F.col("best.n") >= ratio * F.col("n")
    rows = rows.select(
        "word",
        F.when(taken, F.col("best.word")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, -F.col("best.n")).alias("form_n"),
    )
    rows = stored(rows, "spelling-forms")
    rows = rows.join(roots(rows.filter("form IS NOT NULL")), "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def digest(docs: DataFrame) -> DataFrame:
    """The words of all documents, with one run in ``SLIP`` misspelt, under their forms."""
    return variants(counted(slipped(runs(docs.select("doc_id", "text")))))


# The table of the checksum is made from its polynomial; bytes are those of UTF-8 below U+0800.
SQL = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS id, run, COUNT(*) AS n FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(id || run, ''),
           lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [192 | (ord(c) >> 6), 128 | (ord(c) & 63)] END))),
           lambda x, y: xor(x >> 8, tab[1 + (xor(x, y) & 255)]))) AS h
  FROM runs, crc),
words AS (
  SELECT word, CAST(SUM(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, 2 + h % length(run))
                   ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING SUM(n) >= 5),
cut AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, COUNT(*) AS n_near, arg_min(other, (-other_n, other)) AS other, MAX(other_n) AS other_n
  FROM near GROUP BY word),
formed AS (
  SELECT word, CASE WHEN other_n >= 5 * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN other_n >= 5 * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
followed AS (
  SELECT word, coalesce(form, word) AS root, form IS NOT NULL AS more FROM formed
  UNION ALL
  SELECT f.word, g.form, true FROM followed f JOIN formed g ON f.root = g.word WHERE f.more AND g.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (
  SELECT f.word, f.root FROM followed f JOIN formed g ON f.root = g.word WHERE g.form IS NULL) USING (word)
"""
