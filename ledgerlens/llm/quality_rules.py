"""Quality rules as a ledger of bits.

Every rule is evaluated once for each text.  The ledger keeps the measurements and one bit for
each rule that failed; policies are masks over these bits, so that a new version of a policy or
an ablation reads the ledger and never the texts.

Defined results: a null text counts as empty (no words, fails ``too_short``); very long texts are
measured whole.  Ties, repeated
rows and null ids are ordinary rows, each judged alone.  An empty table gives an empty ledger.
Columns of the input stay; new columns that clash with them replace them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import free_name, session_of

WINDOW = 8
MEASURES = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_bangs n_unspaced".split()
)
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
#: Characters of scripts without spaces: Thai and Lao, Burmese, Khmer, kana and Han, with their marks.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3000-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff00-\uffef\U00020000-\U0003ffff"
STRETCHES = re.compile(f"[{UNSPACED}]+")
#: Words that are compared at once, so that memory does not follow the batch.
WORDS_AT_ONCE = 1_000_000


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``fails``, SQL over the measurements, is true.  Bits never change."""

    bit: int
    name: str
    fails: str

    @property
    def mask(self) -> int:
        return 1 << self.bit


@dataclass(frozen=True)
class Policy:
    """A version: rejects what fails any rule of ``rules``."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(r.mask for r in RULES if r.name in self.rules)


RULES = (
    Rule(0, "too_short", "n_words < 20"),
    Rule(1, "repetitive", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "100 * n_symbols > 10 * n_words"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 45 * n_lines"),
    Rule(4, "shouting", "100 * n_bangs > 30 * n_words"),
    Rule(5, "long_words", "word_chars > 14 * n_words"),
    Rule(6, "tiny_words", "word_chars < 2 * n_words"),
    Rule(7, "long_spaced_words", "word_chars - n_unspaced > 14 * n_words"),
)
BASE = Policy("base", ("too_short", "repetitive"))
#: Version 2 rejected clean texts of scripts without spaces for the length of their words.
STRICT_2 = Policy("2", tuple(r.name for r in RULES[:7]))
STRICT = Policy("3", tuple(r.name for r in RULES if r.name != "long_words"))


def repeated_words(codes: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Words of each document that lie in a window of ``WINDOW`` words found twice or more.

    ``codes`` name a word within its document and differ between documents.  Windows are named
    by doubling: a pair of names of width w is renamed to one name of width 2w.
    """
    names, width = codes, 1
    while width < WINDOW:
        if len(names) <= width:
            return np.zeros(n_docs, np.int64)
        pairs = names[:-width] * (int(names.max()) + 1) + names[width:]
        names = np.unique(pairs, return_inverse=True)[1]
        width *= 2
    inside = doc[: len(names)] == doc[WINDOW - 1 :]
    again = inside & (np.bincount(names)[names] > 1)
    edge = np.zeros(len(codes) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    covered = np.cumsum(edge)[:-1] > 0
    return np.bincount(doc[covered], minlength=n_docs)


def measure(texts: Iterable[str | None]) -> pd.DataFrame:
    """The measurements of each text."""
    rows, codes, lengths, repeats = [], [], [], []
    first = 0

    def flush() -> None:
        nonlocal codes, lengths, first
        doc = np.repeat(np.arange(len(lengths)), lengths)
        repeats.append(repeated_words(np.array(codes, np.int64), doc, len(lengths)))
        codes, lengths, first = [], [], 0

    for text in texts:
        text = text or ""
        raw = text.encode("utf-8", "surrogatepass")
        words = raw.split()
        lines = [x for x in text.split("\n") if x.strip(SPACES)]
        known: dict[bytes, int] = {}
        codes += [known.setdefault(w, first + len(known)) for w in words]
        first += len(known)
        lengths.append(len(words))
        rows.append(
            (
                len(words),
                len(text) - sum(map(text.count, SPACES)),
                sum(map(text.count, SYMBOLS)),
                len(lines) - len(set(lines)),
                0,
                len(lines),
                text.count("!"),
                # The first byte of such a character is at least 0xE0; most texts have none.
                sum(map(len, STRETCHES.findall(text))) if np.frombuffer(raw, np.uint8).max(initial=0) >= 0xE0 else 0,
            )
        )
        if len(codes) >= WORDS_AT_ONCE:
            flush()
    flush()
    out = pd.DataFrame(rows, columns=MEASURES, dtype="int64")
    out["n_repeat_words"] = np.concatenate(repeats)
    return out


def ledger(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with the measurements and ``failed_bits``."""
    session_of(docs)

    @F.pandas_udf(", ".join(f"{m} long" for m in MEASURES))
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield measure(texts)

    at = free_name(docs, "measured")
    out = docs.withColumn(at, measured(F.col(text)))
    out = out.withColumns({m: F.col(f"{at}.{m}") for m in MEASURES}).drop(at)
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), rule.mask).otherwise(0).cast("long"))
    return out.withColumn("failed_bits", bits)


def apply_policy(rows: DataFrame, policy: Policy, column: str = "kept") -> DataFrame:
    """Mark the rows of a ledger that a policy keeps."""
    return rows.withColumn(column, F.col("failed_bits").bitwiseAND(policy.mask) == 0)


def ablation(rows: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of a policy: rows that fail it, rows that only it rejects, and rows that the
    policy keeps without it.

    The ledger shrinks to its distinct bit patterns first (at most two to the number of rules).
    """
    patterns = (
        rows.groupBy(F.col("failed_bits").bitwiseAND(policy.mask).alias("bits"))
        .agg(F.count("*").alias("n"))
    )
    rules = [r for r in RULES if r.mask & policy.mask]
    each = F.explode(
        F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.mask).cast("long").alias("mask")) for r in rules])
    )
    n = F.col("n")
    return (
        patterns.select("bits", "n", each.alias("r"))
        .groupBy("r.rule")
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.mask")) != 0, n).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("bits") == F.col("r.mask"), n).otherwise(0)).alias("n_only_this"),
            F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.mask"))) == 0, n).otherwise(0)).alias("n_kept_without"),
        )
    )


def summary(rows: DataFrame, by: str) -> DataFrame:
    """For each group: rows, the bits that some row failed, and the bits that all rows failed."""
    return rows.groupBy(by).agg(
        F.count("*").alias("n_rows"),
        F.bit_or("failed_bits").alias("any_bits"),
        F.bit_and("failed_bits").alias("all_bits"),
    )


def judged(docs: DataFrame) -> DataFrame:
    """The digest of query op1."""
    rows = apply_policy(ledger(docs.select("doc_id", "text")), STRICT)
    base = F.col("failed_bits").bitwiseAND(BASE.mask) != 0
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "kept", "n_lines", "n_bangs", "n_unspaced", "failed_bits",
    )


JUDGED_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
),
win AS (
  SELECT doc_id, i, array_to_string(list_slice(words, i, i + 7), ' ') AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w)
),
twice AS (SELECT doc_id, k FROM win GROUP BY doc_id, k HAVING count(*) > 1),
rep AS (
  SELECT doc_id, count(DISTINCT i + o) AS n
  FROM win JOIN twice USING (doc_id, k), range(0, 8) AS r(o)
  GROUP BY doc_id
),
m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(length(regexp_replace(text, '[^!]', '', 'g')) AS BIGINT) AS n_bangs,
         CAST(length(regexp_replace(text, '[^\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3000}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{FF00}-\x{FFEF}\x{20000}-\x{3FFFF}]', '', 'g')) AS BIGINT) AS n_unspaced
  FROM w LEFT JOIN rep USING (doc_id)
),
b AS (
  SELECT *,
    CAST((CASE WHEN n_words < 20 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END)
    + (CASE WHEN 100 * n_dup_lines > 45 * n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN 100 * n_bangs > 30 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN word_chars > 14 * n_words THEN 32 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words THEN 64 ELSE 0 END)
    + (CASE WHEN word_chars - n_unspaced > 14 * n_words THEN 128 ELSE 0 END) AS BIGINT) AS failed_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed_bits & 3) <> 0 AS base_failed, (failed_bits & 223) = 0 AS kept, n_lines, n_bangs, n_unspaced, failed_bits
FROM b
"""
