"""Work lists, upserts, ingest runs and the stream, over two snapshots of the quarters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens.functions.values import differs
from ledgerlens.operators import ingest, keys, manifest, normalize, upsert
from ledgerlens.session import work_folder
from ledgerlens.sources.store import VersionedStore
from ledgerlens.sources.writers import bucket_count
from ledgerlens.streaming.upsert_stream import stream_upsert, stream_upsert_all
from ledgerlens.workload.registry import register
from ledgerlens.workload.source_queries import provider_names, write_csv_tree

TODAY = "2001-12-31"
MERGE = ["symbol", "calendaryear", "period"]
VALUES = ["revenue", "netincome", "interestexpense", "weightedaverageshsoutdil", "epsdiluted"]

# Written out, so that the check does not lean on the constants under test.
WORK_SQL = """(VALUES
  ('profile', NULL, 'company'),
  ('income-statement', 'quarter', 'income_statement_quarter'),
  ('income-statement', 'fy', 'income_statement_fy'),
  ('balance-sheet-statement', 'quarter', 'balance_sheet_quarter'),
  ('balance-sheet-statement', 'fy', 'balance_sheet_fy'),
  ('cash-flow-statement', 'quarter', 'cash_flow_statement_quarter'),
  ('cash-flow-statement', 'fy', 'cash_flow_statement_fy'),
  ('historical-price-eod/full', NULL, 'price')) w(dataset, period, table_name)"""


@register(
    "manifest_datasets",
    f"SELECT symbol, dataset, period, table_name FROM company, {WORK_SQL}",
)
def manifest_datasets(t):
    return manifest.manifest(t["company"])


@register(
    "manifest_params",
    f"""SELECT symbol, dataset, period, table_name, period AS param_period,
               CASE WHEN dataset = 'historical-price-eod/full' THEN DATE '1900-01-01' END AS param_from,
               CASE WHEN dataset = 'historical-price-eod/full' THEN DATE '{TODAY}' END AS param_to
        FROM company, {WORK_SQL} WHERE period IS NULL OR period = 'quarter'""",
)
def manifest_params(t):
    return manifest.manifest_with_params(manifest.manifest(t["company"], "quarter"), TODAY)


@register(
    "date_chunks",
    """SELECT symbol, CAST(i AS INTEGER) AS chunk_no, CAST(a + i * 366 AS DATE) AS chunk_from,
              LEAST(CAST(a + i * 366 + 365 AS DATE), z) AS chunk_to
       FROM (SELECT symbol, MIN(date) AS a, MAX(date) AS z FROM price GROUP BY symbol) r,
            LATERAL (SELECT CAST(unnest(range(0, 1 + (z - a) // 366)) AS INTEGER) AS i) g
       WHERE a + i * 366 < z""",
)
def date_chunks(t):
    spans = t["price"].groupBy("symbol").agg(
        F.min("date").alias("param_from"), F.max("date").alias("param_to")
    )
    chunks = manifest.date_chunks(spans, max_days=365)
    return chunks.select("symbol", "chunk_no", "chunk_from", "chunk_to")


@register(
    "chunk_union_dedup",
    """SELECT symbol, date, CASE WHEN date <= DATE '1998-12-31' THEN volume ELSE volume + 1000 END
              AS volume FROM price""",
)
def chunk_union_dedup(t):
    # The second chunk starts a month before the first ends and holds other values.
    price = t["price"].select("symbol", "date", "volume")
    first = price.filter(F.col("date") <= F.lit("1998-12-31").cast("date"))
    second = price.filter(F.col("date") > F.lit("1998-11-30").cast("date"))
    second = second.withColumn("volume", F.col("volume") + 1000)
    return manifest.union_chunks([first, second], ["symbol", "date"])


@register(
    "manifest_coverage",
    f"""SELECT symbol, dataset, period, table_name FROM company, (SELECT * FROM {WORK_SQL} WHERE period IS NULL OR period = 'quarter')
        WHERE (dataset IN ('income-statement', 'balance-sheet-statement', 'cash-flow-statement')
               AND symbol NOT IN (SELECT symbol FROM snapshot_old))
           OR (dataset = 'historical-price-eod/full' AND symbol NOT IN (SELECT symbol FROM price))""",
    snapshots=True,
)
def manifest_coverage(t):
    def landed(df: DataFrame, *datasets: str) -> DataFrame:
        names = F.array(*[F.lit(d) for d in datasets])
        return df.select("symbol").distinct().select("symbol", F.explode(names).alias("dataset"))

    statements = ("income-statement", "balance-sheet-statement", "cash-flow-statement")
    got = (
        landed(t["snapshot_old"], *statements)
        .unionByName(landed(t["price"], "historical-price-eod/full"))
        .unionByName(landed(t["company"], "profile"))
    )
    work = manifest.manifest(t["company"], "quarter")
    return manifest.uncovered(work, got, ["symbol", "dataset"])


KNOWN = """
known AS (SELECT id, symbol FROM company WHERE year(ipodate) <= 2015),
resolved AS (
  SELECT id, symbol FROM known UNION ALL
  SELECT (SELECT MAX(id) FROM known) + ROW_NUMBER() OVER (ORDER BY md5(symbol)[1:3], symbol), symbol
  FROM (SELECT DISTINCT symbol FROM statement_fy WHERE symbol NOT IN (SELECT symbol FROM known)))"""


@register(
    "fk_resolve",
    """SELECT s.symbol, s.date, s.revenue, CAST(r.id AS BIGINT) AS company_id
       FROM statement_fy s JOIN resolved r ON r.symbol = s.symbol""",
    ctes=KNOWN,
)
def fk_resolve(t):
    known = t["company"].filter(F.year("ipodate") <= 2015).select("id", "symbol")
    facts = t["income_statement_fy"].select("symbol", "date", "revenue")
    return keys.fk_resolve(facts, keys.with_stubs(facts, known))


MERGE_TABLES = ["company", "income_statement_fy", "balance_sheet_quarter", "price"]


@register(
    "merge_keys",
    """SELECT 'company' AS table_name, 'symbol' AS merge_keys, COUNT(*) AS rows,
              COUNT(DISTINCT symbol) AS distinct_keys FROM company
       UNION ALL
       SELECT 'income_statement_fy', 'symbol,calendaryear,period', COUNT(*),
              COUNT(DISTINCT (symbol, calendaryear, period)) FROM income_statement_fy
       UNION ALL
       SELECT 'balance_sheet_quarter', 'symbol,calendaryear,period', COUNT(*),
              COUNT(DISTINCT (symbol, calendaryear, period)) FROM balance_sheet_quarter
       UNION ALL
       SELECT 'price', 'symbol,date', COUNT(*), COUNT(DISTINCT (symbol, date)) FROM price""",
)
def merge_keys(t):
    def checked(name: str) -> DataFrame:
        by = ingest.keys_of(name)
        # counted per key first, so that no task holds all keys of a table
        per_key = t[name].groupBy(*by).agg(F.count("*").alias("n"))
        return per_key.agg(
            F.sum("n").alias("rows"), F.count("*").alias("distinct_keys")
        ).select(
            F.lit(name).alias("table_name"),
            F.lit(",".join(by)).alias("merge_keys"),
            "rows",
            "distinct_keys",
        )

    first, *rest = [checked(n) for n in MERGE_TABLES]
    for part in rest:
        first = first.unionByName(part)
    return first


def _stored(t):
    return t["snapshot_old"].select(*MERGE, *VALUES)


def _batch(t):
    return t["snapshot_new"].select(*MERGE, *VALUES)


def _restated(t):
    """Each row three times: first with other figures, then as it is, last with holes."""
    batch = _batch(t)
    older = batch.withColumn("revenue", F.col("revenue") + 1).withColumn("netincome", F.lit(0).cast("long"))
    older = older.withColumn("interestexpense", F.lit(None).cast(batch.schema["interestexpense"].dataType))
    holes = batch.select(*MERGE, *[F.lit(None).cast(batch.schema[c].dataType).alias(c) for c in VALUES])
    parts = [p.withColumn("landed", F.lit(i)) for i, p in enumerate((older, batch, holes))]
    return parts[2].unionByName(parts[0]).unionByName(parts[1])


def changed_sql(c: str) -> str:
    """SQL of the change rule for a column of ``n`` (new) and ``o`` (old)."""
    if c == "epsdiluted":
        unequal = f"ROUND(n.{c}, 4) <> ROUND(o.{c}, 4)"
    else:
        unequal = f"n.{c} <> o.{c}"
    return f"(n.{c} IS NOT NULL AND (o.{c} IS NULL OR {unequal}))"


ANY_CHANGE = " OR ".join(changed_sql(c) for c in VALUES)
CHANGED_NAMES = (
    "concat_ws(',', "
    + ", ".join(f"CASE WHEN {changed_sql(c)} THEN '{c}' END" for c in VALUES)
    + ")"
)
KEYS_N = ", ".join(f"n.{k}" for k in MERGE)
BOTH = f"snapshot_new n JOIN snapshot_old o USING ({', '.join(MERGE)})"
LEFT = f"snapshot_new n LEFT JOIN snapshot_old o USING ({', '.join(MERGE)})"


@register(
    "upsert_classify",
    f"""SELECT {KEYS_N}, n.revenue, CASE WHEN o.company_id IS NULL THEN 'insert'
               WHEN {ANY_CHANGE} THEN 'update' ELSE 'same' END AS op FROM {LEFT}""",
    snapshots=True,
)
def upsert_classify(t):
    classified = upsert.classify(upsert.latest_cells(_restated(t), MERGE, ["landed"]), _stored(t), MERGE)
    return classified.select(*MERGE, "revenue", "op")


@register(
    "upsert_insert",
    f"""SELECT {KEYS_N}, {", ".join(f"n.{c}" for c in VALUES)} FROM {LEFT}
        WHERE o.company_id IS NULL""",
    snapshots=True,
)
def upsert_insert(t):
    twice = _batch(t).unionByName(_batch(t))
    return upsert.inserts(upsert.latest_cells(_restated(t), MERGE, ["landed"]), _stored(t), MERGE)


@register(
    "upsert_diff",
    f"SELECT {KEYS_N}, "
    + ", ".join(f"{changed_sql(c)} AS {c}_differs" for c in VALUES)
    + f" FROM {BOTH}",
    snapshots=True,
)
def upsert_diff(t):
    new = _batch(t).select(*MERGE, *[F.col(c).alias(f"new_{c}") for c in VALUES])
    old = _stored(t).select(*MERGE, *[F.col(c).alias(f"old_{c}") for c in VALUES])
    joined = new.join(old, MERGE)
    return joined.select(
        *MERGE,
        *[
            differs(
                F.col(f"new_{c}"), F.col(f"old_{c}"), joined.schema[f"new_{c}"].dataType
            ).alias(f"{c}_differs")
            for c in VALUES
        ],
    )


@register(
    "upsert_update_set",
    f"SELECT {KEYS_N}, "
    + ", ".join(f"CASE WHEN {changed_sql(c)} THEN n.{c} END AS {c}" for c in VALUES)
    + f", {CHANGED_NAMES} AS changed_columns FROM {BOTH} WHERE {ANY_CHANGE}",
    snapshots=True,
)
def upsert_update_set(t):
    updates = upsert.update_set(_batch(t), _stored(t), MERGE)
    return updates.withColumn("changed_columns", F.concat_ws(",", "changed_columns"))


MERGED = ", ".join(
    f"CASE WHEN o.company_id IS NULL OR {changed_sql(c)} THEN n.{c} ELSE o.{c} END AS {c}"
    for c in VALUES
)
FULL = f"snapshot_new n FULL JOIN snapshot_old o USING ({', '.join(MERGE)})"


@register(
    "upsert_apply", f"SELECT {', '.join(MERGE)}, {MERGED} FROM {FULL}", snapshots=True
)
def upsert_apply(t):
    return upsert.apply_batch(_batch(t), _stored(t), MERGE)


@register(
    "update_by_symbol",
    """SELECT c.symbol, COALESCE(v.worth, c.mktcap) AS mktcap, v.worth IS NOT NULL AS updated
       FROM company c LEFT JOIN (
         SELECT symbol, CAST(MAX(cashandcashequivalents) AS BIGINT) AS worth FROM statement_quarter
         WHERE symbol IN (SELECT symbol FROM company WHERE sector = 'EUROPE') GROUP BY symbol) v
       USING (symbol)""",
)
def update_by_symbol(t):
    europe = t["company"].filter("sector = 'EUROPE'").select("symbol")
    worth = (
        t["balance_sheet_quarter"]
        .join(europe, "symbol", "left_semi")
        .groupBy("symbol")
        .agg(F.max("cashandcashequivalents").alias("value"))
    )
    updated = upsert.update_by_symbol(t["company"], "mktcap", worth)
    return updated.select("symbol", "mktcap", "updated")


@register(
    "upsert_log",
    f"""SELECT 'income_statement_quarter' AS table_name, {KEYS_N},
               CASE WHEN o.company_id IS NULL THEN 'insert' ELSE 'update' END AS op,
               CASE WHEN o.company_id IS NULL THEN '' ELSE {CHANGED_NAMES} END AS changed_columns
        FROM {LEFT} WHERE o.company_id IS NULL OR {ANY_CHANGE}""",
    snapshots=True,
)
def upsert_log(t):
    log = upsert.change_log(_batch(t), _stored(t), MERGE, "income_statement_quarter")
    return log.withColumn("changed_columns", F.concat_ws(",", "changed_columns"))


# --- runs over a store -------------------------------------------------------------------


def _store(t) -> VersionedStore:
    buckets = bucket_count(t["company"].count())
    return VersionedStore(t.spark, work_folder(t.spark, "store"), buckets)


def _raw(t, snapshot: str, columns, spoil: bool = False) -> DataFrame:
    """A provider batch; inactive companies send a bad year in their fourth quarters."""
    df = t[snapshot].select("symbol", "date", "calendaryear", "period", *columns)
    if spoil:
        active = t["company"].select("symbol", "isactivelytrading")
        year = F.when(
            ~F.col("isactivelytrading") & (F.col("period") == "Q4"), F.lit("n/a")
        ).otherwise(F.col("calendaryear").cast("string"))
        df = df.join(active, "symbol").withColumn("calendaryear", year).drop("isactivelytrading")
    return df


def _batches(t, snapshot: str, spoil: bool = False) -> dict[str, DataFrame]:
    income = provider_names(_raw(t, snapshot, VALUES, spoil), "income_statement_quarter")
    balance = _raw(t, snapshot, ["totalassets", "longtermdebt"])
    return {
        "income_statement_quarter": income,
        "balance_sheet_quarter": provider_names(balance, "balance_sheet_quarter"),
    }


ACTIVE = "(SELECT symbol FROM company WHERE isactivelytrading)"


@register(
    "ingest_atomic",
    f"""SELECT {", ".join(MERGE)}, {", ".join(VALUES)} FROM (
          SELECT {", ".join(MERGE)}, {MERGED} FROM {FULL} WHERE symbol IN {ACTIVE}
          UNION ALL
          SELECT {", ".join(MERGE)}, {", ".join(VALUES)} FROM snapshot_old
          WHERE symbol NOT IN {ACTIVE})""",
    snapshots=True,
)
def ingest_atomic(t):
    store = _store(t)
    ingest.ingest(store, _batches(t, "snapshot_old"))
    ingest.ingest(store, _batches(t, "snapshot_new", spoil=True))
    return store.read("income_statement_quarter").select(*MERGE, *VALUES)


def _status(t) -> DataFrame:
    raw = _batches(t, "snapshot_new", spoil=True)
    return ingest.ingest_status({n: normalize.normalize(df, n) for n, df in raw.items()})


@register(
    "ingest_status",
    f"""SELECT DISTINCT symbol, symbol IN {ACTIVE} AS ok FROM statement_quarter""",
)
def ingest_status(t):
    return _status(t)


@register(
    "agg_status_counts",
    f"""SELECT COUNT(DISTINCT CASE WHEN symbol IN {ACTIVE} THEN symbol END) AS successful,
               COUNT(DISTINCT CASE WHEN symbol NOT IN {ACTIVE} THEN symbol END) AS failed
        FROM statement_quarter""",
)
def agg_status_counts(t):
    return ingest.status_counts(_status(t))


@register(
    "csv_bootstrap",
    """SELECT s.symbol, date, calendaryear, period, revenue, epsdiluted, CAST(n AS BIGINT) AS company_id
       FROM statement_fy s JOIN (
         SELECT symbol, ROW_NUMBER() OVER (ORDER BY md5(symbol)[1:3], symbol) AS n
         FROM (SELECT DISTINCT symbol FROM statement_fy)) c ON c.symbol = s.symbol""",
)
def csv_bootstrap(t):
    folder = work_folder(t.spark, "bootstrap")
    for name, table in ingest.CSV_FOLDERS.items():
        write_csv_tree(t[table], table, f"{folder}/{name}")
    store = _store(t)
    ingest.csv_bootstrap(store, folder)
    return store.read("income_statement_fy").select(
        "symbol", "date", "calendaryear", "period", "revenue", "epsdiluted", "company_id"
    )


@register(
    "stream_upsert", f"SELECT {', '.join(MERGE)}, {MERGED} FROM {FULL}", snapshots=True
)
def stream_upsert_twice(t):
    store = _store(t)
    landing = work_folder(t.spark, "landing")
    checkpoint = work_folder(t.spark, "stream")
    table = "income_statement_quarter"
    for snapshot in ("snapshot_old", "snapshot_new"):
        batch = provider_names(_raw(t, snapshot, VALUES), table)
        batch.write.mode("append").json(landing)
        stream_upsert(store, landing, table, checkpoint)
    return store.read(table).select(*MERGE, *VALUES)


BALANCES = ["totalassets", "longtermdebt"]
BALANCES_MERGED = ", ".join(
    f"CASE WHEN o.company_id IS NULL OR {changed_sql(c)} THEN n.{c} ELSE o.{c} END AS {c}" for c in BALANCES
)


@register(
    "stream_upsert_all",
    f"SELECT {', '.join(MERGE)}, {MERGED}, {BALANCES_MERGED} FROM {FULL}",
    snapshots=True,
)
def stream_two_tables(t):
    store = _store(t)
    landing = work_folder(t.spark, "landing")
    checkpoint = work_folder(t.spark, "stream")
    for snapshot in ("snapshot_old", "snapshot_new"):
        for table, batch in _batches(t, snapshot).items():
            batch.write.mode("append").json(f"{landing}/{table}")
        stream_upsert_all(store, landing, checkpoint)
    balance = store.read("balance_sheet_quarter").select(*MERGE, *BALANCES)
    return store.read("income_statement_quarter").select(*MERGE, *VALUES).join(balance, MERGE)


@register(
    "upsert_feed",
    f"""SELECT CAST(2 AS INTEGER) AS commit, 'income_statement_quarter' AS table_name, {KEYS_N},
               CASE WHEN o.company_id IS NULL THEN 'insert' ELSE 'update' END AS op,
               CASE WHEN o.company_id IS NULL THEN '' ELSE {CHANGED_NAMES} END AS changed_columns
        FROM {LEFT} WHERE o.company_id IS NULL OR {ANY_CHANGE}""",
    snapshots=True,
)
def upsert_feed(t):
    """What the second of two runs changed, from the feed of the store."""
    store = _store(t)
    for snapshot in ("snapshot_old", "snapshot_new"):
        ingest.ingest(store, {"income_statement_quarter": _batches(t, snapshot)["income_statement_quarter"]})
    feed = ingest.change_log(store, after=1).filter("table_name = 'income_statement_quarter'")
    key = F.from_json("key", "symbol string, calendaryear int, period string")
    names = F.array_intersect(F.array(*map(F.lit, VALUES)), F.col("changed_columns"))
    changed = F.concat_ws(",", F.coalesce(names, F.array().cast("array<string>"))).alias("changed_columns")
    return feed.select("commit", "table_name", *[key[k].alias(k) for k in MERGE], "op", changed)
