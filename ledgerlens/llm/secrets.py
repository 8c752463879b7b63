"""Secret scans: fixed patterns, and a battery of randomness tests.

Patterns find assignments, access keys and hex runs.  Beside them every long token is tested for
randomness within the encoding inferred from its characters: chi-squared uniformity over the
alphabet, number of runs above and below the middle of the alphabet, and serial correlation of
neighbours.  Fisher's method joins the three; a token they reject is not random.  What is left may
still be a word by chance, the more so the shorter it is.  So each token also has a p-value under
the letters of ordinary text, and within its band of lengths the Benjamini-Hochberg rule over all
tokens of the corpus keeps the false discoveries at ``FDR``.

DataFrame functions only.  Texts of any length and with any number of matches are scanned whole, in
about linear time.  Defined results: a null or empty text has no span.  Offsets are code
points, end exclusive.  Equal texts have equal spans; repeated rows each count as tokens of the
corpus.  Null ids need no special case, an empty table gives no row, columns of the input stay and
added ones replace those of their name.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs are matched whole, so that the least length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_VALUE = 8
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
#: Items of an array that are summed up together, and characters of a text that lie together.
BLOCK, CHUNK = 256, 1024
#: Lower bounds of the bands of lengths.
BANDS = (20, 28, 40, 64, 128)
FDR = 0.01
#: Tokens whose joint p-value under randomness is below this are not random.
NOT_RANDOM = 0.001
#: Bins of the natural logarithm of a p-value under text, and how many for each unit.
BIN_STEPS, BIN_MOST = 10, 4000
#: Chance that two, and that three, letters of ordinary English are equal; and that they are if
#: only the letters a to f occur.  Fixed values, from letter frequencies.
TEXT, TEXT_TO_F, NEVER = (0.0655, 0.0054), (0.26, 0.085), (0.0, 0.0)

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings, narrowest first: what the token matches, its alphabet in order, and the chances of
#: equal letters if it were text.  Mere digits are never a discovery.
ENCODINGS = (
    ("[0-9]+", DIGITS, NEVER),
    ("[0-9a-f]+", DIGITS + LOWER[:6], TEXT_TO_F),
    ("[0-9A-F]+", DIGITS + UPPER[:6], TEXT_TO_F),
    ("[a-z]+", LOWER, TEXT),
    ("[A-Z]+", UPPER, TEXT),
    ("[A-Z2-7]+", UPPER + DIGITS[2:8], TEXT),
    ("[a-z0-9]+", DIGITS + LOWER, TEXT),
    ("[A-Z0-9]+", DIGITS + UPPER, TEXT),
    ("[A-Za-z]+", UPPER + LOWER, TEXT),
    ("[A-Za-z0-9]+", UPPER + LOWER + DIGITS, TEXT),
    (".+", UPPER + LOWER + DIGITS + "+/-_=", TEXT),
)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, as a lambda over one element."""
    return F.transform(F.array(value), use)[0]


def in_blocks(items: Column, zero: Column, add: Callable[[Column, Column], Column]) -> Column:
    """Blocks of structs (item, before), where ``before`` is the sum, by ``add`` of a sum and an
    item or of two sums, of what precedes the item.

    A running sum over an array appends to an array at each step.  Here it does so within blocks of
    ``BLOCK`` items, then over the sums of blocks, so that long arrays cost little more than their
    length.
    """
    none = F.array().cast("array<int>")
    state = lambda: F.struct(zero.alias("sum"), none.alias("before"))
    step = lambda s, i: F.struct(add(s["sum"], i).alias("sum"), F.array_append(s["before"], s["sum"]).alias("before"))
    parts = F.transform(
        F.when(F.size(items) > 0, F.sequence(F.lit(0), F.ceil(F.size(items) / BLOCK).cast("int") - 1)).otherwise(none),
        lambda k: F.slice(items, k * BLOCK + 1, F.lit(BLOCK)),
    )
    summed = F.transform(parts, lambda p: F.struct(p.alias("items"), F.aggregate(p, state(), step).alias("run")))

    def placed(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: b["run"]["sum"])
        offsets = F.aggregate(sums, state(), step)["before"]
        whole = lambda b, o: F.transform(
            F.arrays_zip(b["items"].alias("item"), b["run"]["before"].alias("before")),
            lambda x: F.struct(x["item"].alias("item"), add(o, x["before"]).alias("before")),
        )
        return F.flatten(F.zip_with(blocks, offsets, whole))

    return once(summed, placed)


def matches(text: Column, pattern: str, value_group: int = 0) -> Column:
    """Array of (start, end, value) of the leftmost non-overlapping matches.

    The text between matches and the matches take turns, so that running sums of their lengths
    are the offsets.
    """
    p = F.lit(pattern)
    between, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, p, F.lit(0))
    values = F.regexp_extract_all(text, p, F.lit(value_group)) if value_group else hits
    turns = F.zip_with(
        F.slice(between, 1, F.size(hits)),
        F.arrays_zip(hits.alias("hit"), values.alias("value")),
        lambda gap, m: F.struct(F.char_length(gap).alias("gap"), F.char_length(m["hit"]).alias("n"), m["value"].alias("value")),
    )
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def spans(turns: Column) -> Column:
        lengths = F.transform(turns, lambda t: t["gap"] + t["n"])
        return F.zip_with(
            in_blocks(lengths, F.lit(0), lambda s, i: s + i),
            turns,
            lambda at, t: F.struct(
                (at["before"] + t["gap"]).alias("start"), (at["before"] + t["gap"] + t["n"]).alias("end"), t["value"].alias("value")
            ),
        )

    return F.when(text.rlike(pattern), once(turns, spans)).otherwise(none)


def upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal variable, to about seven places (a rational approximation
    of the error function with fixed coefficients)."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    half = poly * F.exp(-x * x) / 2
    return F.greatest(F.when(z >= 0, half).otherwise(1 - half), F.lit(1e-300))


def log_lower_tail(z: Column) -> Column:
    """ln P(Z < z); far out by the leading term of the asymptotic series."""
    far = -z * z / 2 - F.log(-z) - math.log(2 * math.pi) / 2
    return F.when(z < -4, far).otherwise(F.log(upper_tail(-z)))


def tested(token: Column) -> Column:
    """Struct of length, p_random (Fisher over the three tests) and log_p_text of a token."""

    def encoding(letters: str, equal: tuple[float, float]) -> Column:
        two, three = map(F.lit, equal)
        return F.struct(F.lit(letters).alias("a"), two.alias("two"), three.alias("three"))

    inferred = encoding(*ENCODINGS[-1][1:])
    for pattern, *rest in reversed(ENCODINGS[:-1]):
        inferred = F.when(token.rlike(f"^(?:{pattern})$"), encoding(*rest)).otherwise(inferred)
    body = F.struct(token.alias("t"), F.char_length(token).cast("double").alias("n"), inferred.alias("e"))

    def counted(b: Column) -> Column:
        letters = b["e"]["a"]
        same = F.aggregate(
            F.split(letters, ""), F.lit(0.0), lambda s, c: s + F.pow(b["n"] - F.char_length(F.replace(b["t"], c)), F.lit(2.0))
        )
        codes = F.transform(F.split(b["t"], ""), lambda c: (F.instr(letters, c) - 1).cast("double"))
        k = F.char_length(letters).cast("double")
        return F.struct(b["n"].alias("n"), k.alias("k"), same.alias("same"), codes.alias("codes"), b["e"].alias("e"))

    def summed(b: Column) -> Column:
        total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
        left, right = F.slice(b["codes"], F.lit(1), b["n"].cast("int") - 1), F.slice(b["codes"], F.lit(2), b["n"].cast("int") - 1)
        high = lambda v: v >= b["k"] / 2
        turns = total(F.zip_with(left, right, lambda x, y: F.when(high(x) != high(y), 1.0).otherwise(0.0)))
        lag = total(F.zip_with(left, right, lambda x, y: (x - (b["k"] - 1) / 2) * (y - (b["k"] - 1) / 2)))
        return F.struct(*[b[c].alias(c) for c in ("n", "k", "same", "e")], turns.alias("turns"), lag.alias("lag"))

    def judged(b: Column) -> Column:
        n, k = b["n"], b["k"]
        chi = k / n * b["same"] - n
        d = k - 1
        z_chi = (F.pow(F.greatest(chi, F.lit(1e-9)) / d, F.lit(1 / 3)) - (1 - 2 / (9 * d))) / F.sqrt(2 / (9 * d))
        z_runs = (b["turns"] - (n - 1) / 2) / F.sqrt((n - 1) / 4)
        z_lag = b["lag"] / ((k * k - 1) / 12) / F.sqrt(n - 1)
        ps = (upper_tail(z_chi), 2 * upper_tail(F.abs(z_runs)), 2 * upper_tail(F.abs(z_lag)))
        s = -sum(F.log(F.least(p, F.lit(1.0))) for p in ps)
        p_random = F.exp(-s) * (1 + s + s * s / 2)
        # Mean and variance of the sum of squared counts under text, scaled as chi is.
        two, three = b["e"]["two"], b["e"]["three"]
        mean = d + (n - 1) * (k * two - 1)
        variance = k * k * (4 * n * (three - two * two) + 2 * two)
        z_text = F.when(two > 0, (chi - mean) / F.sqrt(variance)).otherwise(1.0)
        return F.struct(n.cast("int").alias("n"), p_random.alias("p_random"), log_lower_tail(z_text).alias("log_p_text"))

    # Each step is a lambda over one element, so that what it uses often is worked out once.
    out = F.array(body)
    for step in (counted, summed, judged):
        out = F.transform(out, step)
    return out[0]


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` (kind, start, end) and ``candidates`` of the battery."""
    t = F.coalesce(F.col(text), F.lit(""))

    def spans(kind: str, found: Column) -> Column:
        return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end")))

    assigned = F.filter(matches(t, ASSIGN, 2), lambda m: F.char_length(m["value"]) >= ASSIGN_VALUE)
    base = F.concat(spans("assign", assigned), spans("access", matches(t, ACCESS)), spans("hex", matches(t, HEX)))
    candidates = F.transform(
        matches(t, TOKEN), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), tested(m["value"]).alias("test"))
    )
    return docs.withColumns({"base_spans": F.array_sort(base), "candidates": candidates})


def band(n: Column) -> Column:
    out = F.lit(BANDS[0])
    for b in BANDS[1:]:
        out = F.when(n >= b, b).otherwise(out)
    return out


def limits(scanned: DataFrame) -> dict[int, float]:
    """For each band of lengths, the largest ln p-value under text that is a discovery.

    Tokens that the battery rejects count as tokens that are no discovery.  P-values are counted
    in bins and taken as the upper edge of theirs.
    """
    c = F.col("c")
    at = F.when(c["test"]["p_random"] < NOT_RANDOM, 0.0).otherwise(c["test"]["log_p_text"])
    bins = (
        scanned.select(F.explode("candidates").alias("c"))
        .select(band(c["test"]["n"]).alias("band"), F.greatest(F.ceil(at * BIN_STEPS), F.lit(-BIN_MOST)).cast("int").alias("bin"))
        .groupBy("band", "bin")
        .agg(F.count("*").alias("n"))
    )
    within = Window.partitionBy("band")
    upto = F.sum("n").over(within.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    most = F.log(F.lit(FDR) * upto / F.sum("n").over(within))
    passed = bins.withColumn("most", most).filter(F.col("bin") / BIN_STEPS <= F.col("most"))
    # One row for each band at most.
    return {r["band"]: r["bin"] / BIN_STEPS for r in passed.groupBy("band").agg(F.max("bin").alias("bin")).collect()}


def found(scanned: DataFrame, at_most: Mapping[int, float]) -> DataFrame:
    """``scanned`` with ``all_spans``: those of the patterns and the discoveries of the battery."""

    def discovery(c: Column) -> Column:
        limit = F.lit(-math.inf)
        for b, most in at_most.items():
            limit = F.when(band(c["test"]["n"]) == b, most).otherwise(limit)
        return (c["test"]["p_random"] >= NOT_RANDOM) & (c["test"]["log_p_text"] <= limit)

    random = F.transform(
        F.filter("candidates", discovery),
        lambda c: F.struct(c["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), c["end"].alias("end")),
    )
    return scanned.withColumn("all_spans", F.array_sort(F.concat("base_spans", random)))


def named(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, by: str = "[SECRET]") -> Column:
    """``text`` with each stretch that spans cover replaced once.

    The text is cut in chunks, from which the pieces between the spans are taken, so that none is
    sought from the beginning of the text; the pieces are joined once.
    """

    def replaced(c: Column) -> Column:
        def piece(start: Column, end: Column) -> Column:
            first, last = (F.floor(x / CHUNK).cast("int") for x in (start, end))
            near = F.array_join(F.slice(c["chunks"], first + 1, last - first + 1), "")
            return F.substring(near, start - first * CHUNK + 1, end - start)

        ends = F.transform(c["spans"], lambda s: s["end"])
        pieces = F.zip_with(
            in_blocks(ends, F.lit(0), F.greatest),
            c["spans"],
            lambda x, s: F.when(s["start"] < x["before"], "").otherwise(F.concat(piece(x["before"], s["start"]), F.lit(by))),
        )
        last = F.array_max(ends)
        return F.concat(F.array_join(pieces, ""), piece(last, F.greatest(last, F.char_length(c["text"]))))

    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    cut = F.struct(text.alias("text"), spans.alias("spans"), chunks.alias("chunks"))
    return F.when(F.size(spans) > 0, once(cut, replaced)).otherwise(text)


def counts() -> dict[str, Column]:
    def n(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long")

    return {f"n_{k}": n(k) for k in KINDS[:3]}


def digest(docs: DataFrame) -> DataFrame:
    """Per document: spans by kind, their hash, and all spans."""
    scanned = stored(scan(docs.select("doc_id", "text")).drop("text"), "secrets")
    rows = found(scanned, limits(scanned)).withColumns(counts())
    return rows.select(
        "doc_id", *counts(), F.sha2(named(F.col("base_spans")), 256).alias("base_sha256"), named(F.col("all_spans")).alias("spans"),
        (F.size("all_spans") - F.size("base_spans")).cast("long").alias("n_random"),
    )
