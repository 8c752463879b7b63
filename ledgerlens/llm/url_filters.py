"""URL filters as a sort-merge range join of canonical keys and nested rules.

A host is turned around label by label ("www.example.net" becomes "net.example.www."), so that a
rule for a host and all its subdomains is the interval of keys that begin with its key.  URLs are
range-partitioned by key and sorted; rules go to every part that their interval meets.  A sweep
over each part in order of keys keeps a stack of the rules whose interval is open, each nested in
the one below, and judges a URL by the longest open rule whose path begins the URL's path.

Defined results: a null URL, or one without "://", has an empty host and path.  The longest rule
is the one with most characters in host and path; equal lengths go to the longer host, then to
the lesser rule text and verdict, and repeated rules count once.  A rule with an empty host is open for all keys;
rules with a null part are left out, a null path is an empty one.  URLs that no rule fits get
``default`` and a null rule.  Repeated rows and null ids need no special case; an empty table of
rules leaves all URLs to the default, an empty table of URLs gives no row.  Columns of the input
stay, added ones replace those of their name.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlens.llm.common import session_of, stored

RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
OWN = ["host", "path", "rule", "verdict"]
#: A key after all keys that begin with a given one: its last "." replaced by the next character.
AFTER = "/"


def lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1), F.lit(""))


def key_of(host: Column) -> Column:
    """The labels turned around, each followed by a dot; an empty host has an empty key."""
    turned = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))
    return F.when(F.length(host) > 0, turned).otherwise("")


class Sweep:
    """Judges URLs that come in order of keys, between the rules of their part.

    ``open`` is the stack: lists of the rules of one key, each key a prefix of those above."""

    def __init__(self, default: str):
        self.default, self.part, self.key = default, None, None
        self.open: list[list[tuple[str, str, str, str]]] = []
        self.order: list[tuple[str, str, str, str]] = []

    def move(self, part: int, key: str) -> None:
        if part != self.part:
            self.part, self.open = part, []
        while self.open and not key.startswith(self.open[-1][0][0]):
            self.open.pop()
        self.key = key

    def rule(self, part: int, rule: tuple[str, str, str, str]) -> None:
        self.move(part, rule[0])
        if self.open and self.open[-1][0][0] == rule[0]:
            self.open[-1].append(rule)
        else:
            self.open.append([rule])
        self.key = None

    def url(self, part: int, key: str, path: str) -> tuple[str | None, str]:
        if part != self.part or key != self.key:
            self.move(part, key)
            inside = (r for same in self.open for r in same)
            self.order = sorted(inside, key=lambda r: (-len(r[2]), -len(r[0]), r[2], r[3]))
        return next(((r[2], r[3]) for r in self.order if path.startswith(r[1])), (None, self.default))


def judged(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict; ``rules`` has host, path and verdict."""
    spark = session_of(pages)
    kept = [c for c in pages.columns if c.lower() not in OWN]
    urls = pages.select(F.struct(*kept).alias("row"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The path and a hash part the URLs of one host.
    order = ["key", "path", F.xxhash64("row")]
    ranged = urls.withColumn("key", key_of(F.col("host"))).repartitionByRange(parts, *order)
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()), "url-parts")

    # First and last key of each part: a row for each of the partitions.
    edges = ranged.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last")).orderBy("part").collect()
    numbers, lasts, firsts = [r["part"] for r in edges], [r["last"] for r in edges], [r["first"] for r in edges]

    def parts_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The parts that the interval of a rule meets."""
        for b in batches:
            begin = [bisect_left(lasts, k) for k in b["key"]]
            end = [bisect_left(firsts, k[:-1] + AFTER) if k else len(firsts) for k in b["key"]]
            yield b.assign(part=[numbers[x:y] for x, y in zip(begin, end, strict=True)])

    host, path = lower(F.col("host")), F.coalesce("path", F.lit(""))
    known = rules.filter(F.col("host").isNotNull() & F.col("verdict").isNotNull())
    known = known.select(key_of(host).alias("key"), path.alias("path"), F.concat(host, path).alias("rule"), "verdict").distinct()
    placed = known.mapInPandas(parts_of, "key string, path string, rule string, verdict string, part array<int>")
    placed = placed.withColumn("part", F.explode("part")).withColumn("kind", F.lit(0))
    events = ranged.withColumn("kind", F.lit(1)).unionByName(placed, allowMissingColumns=True)
    events = events.repartition(parts, "part").sortWithinPartitions("part", "key", "kind", "path", "rule", "verdict")

    def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep = Sweep(default)
        for b in batches:
            found = []
            rows = zip(*(b[c].to_pylist() for c in ("kind", "part", "key", "path", "rule", "verdict")), strict=True)
            for kind, part, key, path, rule, verdict in rows:
                if kind:
                    found.append(sweep.url(part, key, path))
                else:
                    sweep.rule(part, (key, path, rule, verdict))
            urls = b.filter(pc.equal(b["kind"], 1))
            hits = [pa.array([f[i] for f in found], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([urls["row"], urls["host"], urls["path"], *hits], ["row", *OWN])

    shape = StructType([ranged.schema["row"], *(StructField(c, StringType()) for c in OWN)])
    out = events.select("kind", "part", "key", "path", "rule", "verdict", "row", "host").mapInArrow(swept, shape)
    return out.select(*[F.col("row")[c].alias(c) for c in kept], *OWN)


SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS u, position('://' IN coalesce(url, '')) AS i FROM pages
),
r AS (SELECT page_id, CASE WHEN i > 0 THEN substr(u, i + 3) ELSE '' END AS rest FROM p),
h AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM r
),
rules(rh, rp, rv) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
m AS (
  SELECT page_id, rh || rp AS rule, rv,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC) AS n
  FROM h JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
)
SELECT h.page_id, host, path, rule, coalesce(rv, 'allow') AS verdict
FROM h LEFT JOIN m ON h.page_id = m.page_id AND n = 1
"""
