"""Language identification by interpolated Kneser-Ney character models.

1. Spark counts, over all texts to learn from, the character n-grams of the words of each language
   (a word begins with "^" and ends with "$"); a task counts its distinct words first.
2. Highest-order grams keep their counts, lower orders count the distinct characters before them;
   each order is discounted by n1/(n1 + 2 n2) and interpolated with the next.  These are groupings
   and joins of the table of grams.  A model is sorted arrays of hashes: of grams with their
   probability, and of contexts with the weight of the lower order.
3. Every text is scored once: cross-entropies per character in each language, and characters.  Words
   share their windows of ``ORDER`` characters, and a window is looked up once in a worker.
4. From the stored scores of the texts to learn from come the temperature, fitted on a bounded
   sample, and the limits of rejection.  A text gets the language of least cross-entropy; the score
   is the probability of that choice, and ``rejected`` marks texts whose cross-entropy is above
   nearly all texts of that language to learn from.

Every text is counted and scored whole, however long.  A model keeps every gram of its language: 16
bytes for each gram and context on the driver and in the workers, bounded by the grams of a script
and not by the rows.  Defined results: a null text, or one without letters, is ``und`` with score 0
and not rejected, as is every text if nothing was learnt.  Ties go to the lesser name.  Repeated
rows, null ids and null languages need no special case (a null language teaches nothing); an empty
table gives no row.  Columns of the input stay, added ones replace those of their name.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import free_name, held_out, pieces, stored
from ledgerlens.llm.segments import Codes

ORDER = 4
#: Texts that the temperature is fitted on.
SAMPLE = 2_000
TEMPERATURES = (0.25, 0.5, 1.0, 2.0, 4.0, 8.0, 16.0)
#: Share of a language's texts to learn from whose cross-entropy is within the limit, and bins of
#: the cross-entropy for each unit.
WITHIN = 0.995
STEPS = 4096
#: Distinct tokens, and windows, that a worker remembers, and tokens that it counts at once.
REMEMBERED, WINDOWS = 300_000, 1_000_000
COUNTED = 400_000
UNKNOWN = "und"


def letters(token: str) -> str:
    return token if token.isalpha() else "".join(filter(str.isalpha, token))


def grams(word: str) -> list[str]:
    """For each character of the word and its end: it and the characters before it."""
    s = f"^{word}$"
    return [s[max(0, i - ORDER + 1) : i + 1] for i in range(1, len(s))]


def hashed(codes: np.ndarray) -> np.ndarray:
    """Hash of each row of characters; zeros stand for no character."""
    h = np.zeros(len(codes), np.uint64)
    for column in codes.T:
        h = h * np.uint64(0x100000001B3) + column.astype(np.uint64)
    h ^= h >> np.uint64(32)
    return h * np.uint64(0x9E3779B97F4A7C15)


def windows(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The last ``ORDER`` characters up to each character of each word and its end, zeros on the
    left; the word of each such row; and the rows of each word, none for an empty one."""
    sizes = np.array([len(w) + 1 if w else 0 for w in words], np.int64)
    joined = "".join(f"\0\0^{w}$" for w in words if w)  # zeros on the left of each word
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    padded = np.concatenate([np.zeros(ORDER - 3, np.int64), points])
    rows = np.lib.stride_tricks.sliding_window_view(padded, ORDER) if len(padded) >= ORDER else np.zeros((0, ORDER), np.int64)
    width = np.where(sizes > 0, sizes + 3, 0)
    starts = np.cumsum(width) - width
    owner = np.repeat(np.arange(len(words)), sizes)
    nth = np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner]
    # The window that ends at a character of the padded text, for all characters after "^".
    codes = rows[starts[owner] + nth + 1] if len(owner) else np.zeros((0, ORDER), np.int64)
    return np.where(np.arange(ORDER) >= ORDER - 2 - nth[:, None], codes, 0), owner, sizes


def counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n), summed in the workers first, by distinct words."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens: dict[str, Counter] = defaultdict(Counter)

        def out() -> Iterator[pd.DataFrame]:
            for k, c in tokens.items():
                words: Counter = Counter()
                for token, n in c.items():
                    words[letters(token)] += n
                codes, owner, _ = windows(list(words))
                _, at, same = np.unique(hashed(codes), return_index=True, return_inverse=True)
                n = np.bincount(same, np.fromiter(words.values(), np.int64)[owner], len(at)) if len(at) else []
                names = ["".join(map(chr, filter(None, row))) for row in codes[at].tolist()]
                yield pd.DataFrame({"lang": k, "gram": pd.Series(names, dtype=object), "n": np.array(n, np.int64)})
            tokens.clear()

        for b in batches:
            for t, k in zip(b["text"], b["lang"], strict=True):
                tokens[k].update(t.lower().split())
            if sum(map(len, tokens.values())) > COUNTED:
                yield from out()
        yield from out()

    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).dropna()
    parts = rows.mapInPandas(counted, "lang string, gram string, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def hash_strings(strings: Sequence[str]) -> np.ndarray:
    codes = np.zeros((len(strings), ORDER), np.int64)
    for i, s in enumerate(strings):
        codes[i, ORDER - len(s) :] = list(map(ord, s))
    return hashed(codes)


class Table:
    """Sorted hashes and their values."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    @classmethod
    def of(cls, values: dict[str, float]) -> Table:
        return cls(hash_strings(list(values)), np.array(list(values.values())))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, NaN where there is none."""
        if not len(self.keys):
            return np.full(len(keys), np.nan)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], np.nan)


class LanguageModel:
    """Logarithms of the probabilities of grams and of the weights below contexts, in tables."""

    def __init__(self, grams: Table, contexts: Table, alphabet: int):
        self.grams, self.contexts, self.floor = grams, contexts, 1 / alphabet

    def log_p(self, codes: np.ndarray) -> np.ndarray:
        """ln p of the last character of each row after those before it; zeros pad to the left."""
        out = np.zeros(len(codes))
        open_ = np.arange(len(codes))
        codes = codes.copy()
        for k in range(ORDER, 0, -1):
            # Rows that are shorter than this order wait.
            now = codes[open_, ORDER - k] != 0
            rows = open_[now]
            found = self.grams.find(hashed(codes[rows]))
            hit = ~np.isnan(found)
            out[rows[hit]] += found[hit]
            missed = rows[~hit]
            context = np.zeros((len(missed), ORDER), np.int64)
            context[:, 1:] = codes[missed, :-1]
            out[missed] += np.nan_to_num(self.contexts.find(hashed(context)))
            codes[missed, ORDER - k] = 0
            open_ = np.concatenate([open_[~now], missed])
        out[open_] += np.log(self.floor)
        return out


def levels(raw: DataFrame, alphabet: int) -> tuple[DataFrame, DataFrame]:
    """(lang, gram, p) of all orders, and (lang, context, weight), from (lang, gram, n).

    Interpolated Kneser-Ney, an order after the other; each order is a stored table.
    """
    by_order = [raw.filter(F.char_length("gram") == ORDER)]
    for k in range(ORDER - 1, 0, -1):
        # Below the highest order a gram counts the characters before it; those at the beginning
        # of a word have none and keep their counts.
        before = by_order[0].groupBy("lang", F.expr("substring(gram, 2)").alias("gram")).agg(F.count("*").alias("n"))
        by_order.insert(0, stored(raw.filter(F.char_length("gram") == k).unionByName(before), "language-counts"))
    grams, contexts = [], []
    for k, counted in enumerate(by_order, 1):
        ones, twos = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
        d = F.when((ones > 0) & (twos > 0), ones / (ones + 2 * twos)).otherwise(0.5)
        discount = counted.groupBy("lang").agg(d.alias("d"))
        mine = counted.withColumn("context", F.expr(f"left(gram, {k - 1})"))
        after = mine.groupBy("lang", "context").agg(F.sum("n").alias("all"), F.count("*").alias("kinds"))
        after = after.join(discount, "lang").withColumn("weight", F.col("d") * F.col("kinds") / F.col("all"))
        rows = mine.join(after, ["lang", "context"])
        if k == 1:
            rows = rows.withColumn("low", F.lit(1 / alphabet))
        else:
            lower = grams[-1].select("lang", F.col("gram").alias("lower"), F.col("p").alias("low"))
            rows = rows.withColumn("lower", F.expr("substring(gram, 2)")).join(lower, ["lang", "lower"])
        p = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("all") + F.col("weight") * F.col("low")
        grams.append(stored(rows.select("lang", "gram", p.alias("p")), "language-grams"))
        contexts.append(after.select("lang", "context", "weight"))
    return reduce(DataFrame.unionByName, grams), reduce(DataFrame.unionByName, contexts)


def tables(rows: DataFrame) -> dict[str, Table]:
    """A table for each language, from (lang, string, value): tasks hash, the driver gets two
    numbers for each row and sorts them."""

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = hash_strings(b.column(1).to_pylist()).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys), pa.array(np.log(b.column(2).to_numpy()))], ["lang", "key", "value"])

    found = rows.mapInArrow(numbers, "lang string, key long, value double").toArrow()
    out = {}
    for k in pc.unique(found["lang"]).to_pylist():
        mine = found.filter(pc.equal(found["lang"], k))
        out[k] = Table(mine["key"].to_numpy().view(np.uint64), mine["value"].to_numpy())
    return out


def models(raw: DataFrame) -> Identifier:
    """The identifier of the languages of (lang, gram, n), nothing fitted yet."""
    alphabet = raw.select(F.expr("right(gram, 1)").alias("last")).distinct().count() + 1
    grams, contexts = map(tables, levels(raw, alphabet))
    return Identifier({k: LanguageModel(grams[k], contexts[k], alphabet) for k in sorted(grams)})


class Identifier:
    """Models of all languages, and what was fitted."""

    def __init__(self, of: dict[str, LanguageModel]):
        self.names = sorted(of)
        self.models = [of[k] for k in self.names]
        self.temperature = 1.0
        self.limits = np.full(len(self.names), np.inf)
        self.clear()
        self.forget()

    def forget(self) -> None:
        self.seen = np.zeros(0, np.uint64)
        self.seen_p = np.zeros((0, len(self.names)))

    def window_log_p(self, codes: np.ndarray) -> np.ndarray:
        """ln p of the last character of each row in each language; a window is looked up once."""
        keys = hashed(codes)
        if len(self.seen):
            at = np.minimum(np.searchsorted(self.seen, keys), len(self.seen) - 1)
            new = np.flatnonzero(self.seen[at] != keys)
        else:
            new = np.arange(len(keys))
        if len(new):
            fresh, first = np.unique(keys[new], return_index=True)
            if len(self.seen) + len(fresh) > WINDOWS:
                self.forget()
                fresh, first = np.unique(keys, return_index=True)
                new = np.arange(len(keys))
            rows = codes[new[first]]
            found = [m.log_p(rows) for m in self.models]
            self.seen = np.concatenate([self.seen, fresh])
            self.seen_p = np.concatenate([self.seen_p, np.stack(found, axis=1) if found else np.zeros((len(rows), 0))])
            order = np.argsort(self.seen)
            self.seen, self.seen_p = self.seen[order], self.seen_p[order]
            at = np.searchsorted(self.seen, keys)
        return self.seen_p[at] if len(keys) else np.zeros((0, len(self.names)))

    def clear(self) -> None:
        self.known = Codes()
        self.log_p = np.zeros((0, len(self.names)))
        self.sizes = np.zeros(0, np.int64)

    def words(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ln p of each token in each language, and its characters; a token without letters has none."""
        codes, owner, sizes = windows(list(map(letters, tokens)))
        log_p = self.window_log_p(codes)
        out = np.zeros((len(tokens), len(self.names)))
        for j in range(len(self.names)):
            out[:, j] = np.bincount(owner, log_p[:, j], len(tokens))
        return out, sizes

    def entropies(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy of each text in each language, and its characters."""
        if len(self.known) > REMEMBERED:
            self.clear()
        tokens = [(t or "").lower().split() for t in texts]
        known, first = self.known, len(self.known)
        codes = np.fromiter(map(known.__getitem__, chain.from_iterable(tokens)), np.int64)
        if len(known) > first:
            log_p, sizes = self.words(list(islice(known, first, None)))
            self.log_p, self.sizes = np.concatenate([self.log_p, log_p]), np.concatenate([self.sizes, sizes])
        doc = np.repeat(np.arange(len(texts)), [len(t) for t in tokens])
        n = np.bincount(doc, self.sizes[codes], len(texts))
        sums = [np.bincount(doc, self.log_p[codes, j], len(texts)) for j in range(len(self.names))]
        sums = np.stack(sums, axis=1) if sums else np.zeros((len(texts), 0))
        return -sums / np.maximum(n, 1)[:, None], n

    def posterior(self, entropies: np.ndarray, n: np.ndarray, temperature: float) -> np.ndarray:
        z = -entropies * np.sqrt(n)[:, None] * temperature
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def calibrate(self, entropies: np.ndarray, n: np.ndarray, truth: Sequence[str]) -> None:
        """The temperature of least log-loss."""
        right = np.array([self.names.index(t) if t in self.names else -1 for t in truth])
        use = (right >= 0) & (n > 0)
        if not use.any():
            return
        e, n, right = entropies[use], n[use], right[use]
        at = np.arange(len(right))
        loss = [-np.log(np.maximum(self.posterior(e, n, t)[at, right], 1e-12)).mean() for t in TEMPERATURES]
        self.temperature = TEMPERATURES[int(np.argmin(loss))]

    def judge(self, texts: Sequence[str | None]) -> pd.DataFrame:
        e, n = self.entropies(texts)
        if not self.names:
            return pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0, "entropy": 0.0, "rejected": False})
        best = e.argmin(axis=1)
        at = np.arange(len(texts))
        some = n > 0
        return pd.DataFrame(
            {
                "lang_pred": np.where(some, np.array(self.names, object)[best], UNKNOWN),
                "score": np.where(some, self.posterior(e, n, self.temperature)[at, best], 0.0),
                "entropy": np.where(some, e[at, best], 0.0),
                "rejected": some & (e[at, best] > self.limits[best]),
            }
        )


def measured(docs: DataFrame, own: Identifier, text: str, entropies: str, size: str) -> DataFrame:
    """``docs`` with the cross-entropies of each text, in the order of the languages, and its
    characters."""
    shared = docs.sparkSession.sparkContext.broadcast(own)

    @F.pandas_udf("e array<double>, n double")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [shared.value.entropies(part) for part in pieces(texts)]
            e, n = (list(chain.from_iterable(x)) for x in (zip(*found, strict=True) if found else ((), ())))
            yield pd.DataFrame({"e": pd.Series(e, dtype=object), "n": np.array(n, float)})

    at = free_name(docs, "measured")
    out = docs.withColumn(at, measure(F.col(text)))
    return out.withColumns({entropies: F.col(at)["e"], size: F.col(at)["n"]}).drop(at)


def calibrate(own: Identifier, scored: DataFrame) -> Identifier:
    """``own`` with temperature and limits from the texts to learn from, stored as (doc_id, lang, e,
    n).  The temperature is fitted on the ``SAMPLE`` rows first by a hash of their id."""
    order = [F.xxhash64("doc_id"), "doc_id", "lang", "n", "e"]
    found = scored.select("doc_id", "lang", "n", "e").orderBy(*order).limit(SAMPLE).collect()
    if found:
        e = np.array([r["e"] for r in found]).reshape(len(found), len(own.names))
        own.calibrate(e, np.array([r["n"] for r in found]), [r["lang"] for r in found])
    names = F.array(*map(F.lit, own.names))
    mine = F.get("e", (F.array_position(names, F.col("lang")) - 1).cast("int"))
    for r in limits(scored.withColumn("mine", mine)).collect():  # one row for each language
        own.limits[own.names.index(r["lang"])] = r["most"]
    own.clear()
    return own


def teaching(docs: DataFrame, learn: Column, text: str, lang: str) -> DataFrame:
    return docs.filter(learn & F.col(lang).isNotNull() & F.col(text).isNotNull())


def train(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang") -> Identifier:
    """Models from the rows where ``learn``, a condition on doc_id."""
    rows = teaching(docs, learn, text, lang).select("doc_id", F.col(text).alias("text"), F.col(lang).alias("lang"))
    own = models(stored(counts(rows, "text", "lang"), "language-raw"))
    if not own.names:
        return own
    return calibrate(own, stored(measured(rows, own, "text", "e", "n").drop("text"), "language-entropies"))


def limits(scored: DataFrame) -> DataFrame:
    """(lang, most): the upper edge of the bin in which a language's share ``WITHIN`` is reached."""
    bins = scored.filter("n > 0 AND mine IS NOT NULL").groupBy("lang", F.floor(F.col("mine") * STEPS).alias("bin")).agg(F.count("*").alias("texts"))
    within = Window.partitionBy("lang")
    upto = F.sum("texts").over(within.orderBy("bin"))
    reached = bins.withColumns({"upto": upto, "all": F.sum("texts").over(within)}).filter(F.col("upto") >= F.col("all") * WITHIN)
    return reached.groupBy("lang").agg(((F.min("bin") + 1) / STEPS).alias("most"))


def named(scored: DataFrame, own: Identifier, entropies: str, size: str) -> DataFrame:
    """``scored`` with lang_pred, score, entropy and rejected, in place of its two columns."""
    e, n = F.col(entropies), F.col(size)
    if not own.names:
        return scored.drop(entropies, size).withColumns(
            {"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "entropy": F.lit(0.0), "rejected": F.lit(False)}
        )
    some, least = n > 0, F.array_min(e)
    best = F.array_position(e, least).cast("int")
    odds = F.transform(e, lambda x: F.exp((least - x) * F.sqrt(n) * own.temperature))
    score = 1 / F.aggregate(odds, F.lit(0.0), lambda s, x: s + x)
    limit = F.element_at(F.lit([float(x) for x in own.limits]), best)
    found = F.struct(
        F.when(some, F.element_at(F.lit(own.names), best)).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(some, score).otherwise(0.0).alias("score"),
        F.when(some, least).otherwise(0.0).alias("entropy"),
        (some & (least > limit)).alias("rejected"),
    )
    at = free_name(scored, "language")
    out = scored.withColumn(at, found).drop(entropies, size)
    return out.withColumns({c: F.col(at)[c] for c in ("lang_pred", "score", "entropy", "rejected")}).drop(at)


def identified(docs: DataFrame, own: Identifier, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score, entropy and rejected."""
    e, n = free_name(docs, "entropies_of"), free_name(docs, "characters_of")
    return named(measured(docs, own, text, e, n), own, e, n)


def digest(docs: DataFrame) -> DataFrame:
    """Every document is scored once; the fit takes the scores of the rows to learn from."""
    docs = docs.select("doc_id", "text", "lang")
    out = held_out("doc_id", 4, 2)
    own = models(stored(counts(teaching(docs, ~out, "text", "lang"), "text", "lang"), "language-raw"))
    scored = docs.withColumn("taught", ~out & F.col("lang").isNotNull() & F.col("text").isNotNull())
    scored = stored(measured(scored, own, "text", "e", "n").drop("text"), "language-entropies")
    if own.names:
        own = calibrate(own, scored.filter("taught"))
    rows = named(scored.drop("lang", "taught"), own, "e", "n")
    return rows.select("doc_id", out.alias("held_out"), "lang_pred", "score", "entropy", "rejected")
