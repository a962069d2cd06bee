"""Query catalogue: the engine's operators over the driver tables, with a DuckDB statement for each.

The tables hold no energy data, so each query applies an operator to columns that have the shape it
needs. Every query reads its whole tables.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import business_day, the_one, utc_text
from ..operators import spikes
from ..operators.dedup import accounting, keep_last
from ..control import recent
from ..operators.enrich import difference, freshness, lookup, orphans, reconcile
from ..operators.quality import Rule, reasons
from ..operators.upsert import insert_absent, ordered_json, upsert
from ..session import ensure
from ..sources.live import newest_link
from ..sources.multirecord import DEMAND, PRICE, carry_headers, join_reports
from . import catalog_runs

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
SYDNEY = "Australia/Sydney"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str):
    """Register a query under its function's name, with its oracle."""

    def add(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure(spark)
            return build(lambda name: _read(spark, sf_dir, name), spark)

        run.__name__, run.__doc__ = build.__name__, build.__doc__
        QUERIES[build.__name__], ORACLES[build.__name__] = run, sql
        return run

    return add


@query("""
WITH m(n, region, wall, demand, price, seq) AS (VALUES (1,'NSW1',TIMESTAMP '2024-04-07 10:00:00',8200.0,72.5,1),(2,'NSW1',TIMESTAMP '2024-04-07 10:00:00',8250.0,70.0,2),
  (3,'VIC1',TIMESTAMP '2024-04-07 10:30:00',5100.0,65.0,1),(4,'QLD1',TIMESTAMP '2024-04-07 11:00:00',-1.0,80.0,1),(5,'NSW1',TIMESTAMP '2024-04-07 11:30:00',8300.0,NULL,1),(6,'NSW1',TIMESTAMP '2024-01-15 10:00:00',8100.0,68.0,1)),
w(n, region, wall, temp, seq) AS (VALUES (1,'NSW1',TIMESTAMP '2024-04-07 10:00:00',24.0,1),(2,'VIC1',TIMESTAMP '2024-04-07 10:30:00',18.5,1),(3,'NSW1',TIMESTAMP '2024-04-07 10:00:00',24.5,2),
  (4,'QLD1',TIMESTAMP '2024-04-07 11:00:00',NULL,1),(5,'NSW1',TIMESTAMP '2024-01-15 10:00:00',29.0,1)),
ms AS (SELECT * FROM m WHERE demand >= 0 AND price IS NOT NULL QUALIFY row_number() OVER (PARTITION BY region, wall ORDER BY seq DESC, n DESC) = 1),
ws AS (SELECT * FROM w WHERE temp IS NOT NULL QUALIFY row_number() OVER (PARTITION BY region, wall ORDER BY seq DESC, n DESC) = 1)
SELECT ms.region, strftime(timezone('UTC', timezone('Australia/Sydney', ms.wall)), '%Y-%m-%dT%H:%M:%SZ') AS interval_utc,
       CAST(demand AS DOUBLE) AS demand_mw, CAST(price AS DOUBLE) AS price_per_mwh, CAST(temp AS DOUBLE) AS temperature_c,
       CAST(ms.n AS BIGINT) AS market_line, CAST(ws.n AS BIGINT) AS weather_line
FROM ms LEFT JOIN ws USING (region, wall)
""")
def gold_fixture(read, spark):
    """The packaged contract from JSON lines to Gold, without publication."""
    from ..contract import load
    from . import layers
    from .run import DEFAULT_METADATA

    contract = load(DEFAULT_METADATA)
    at = contract.ingested_at("fixture")
    silver = {}
    for s in contract.sources:
        accepted, _ = layers.refine(layers.bronze(spark, s, at), s)
        silver[s.source_id] = layers.silver(accepted, s)
    gold = layers.gold(silver[contract.market().source_id], silver[contract.weather().source_id], contract, at)
    return gold.select("region", utc_text(F.col("interval_utc")).alias("interval_utc"), "demand_mw", "price_per_mwh", "temperature_c", F.col("lineage.market.source_row_number").alias("market_line"), F.col("lineage.weather.source_row_number").alias("weather_line"))


@query("""
SELECT event_id, props AS raw_line, sha256(props) AS raw_sha256, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       CASE json_type(props) WHEN 'OBJECT' THEN true ELSE false END AS is_object FROM events
""")
def bronze_line_capture(read, spark):
    """Raw lines kept verbatim beside their parsed value and hash."""
    from ..functions.json import Field, is_object, parse_strict

    rows = read("events").select("event_id", F.col("props").alias("raw_line"), parse_strict(F.col("props")).alias("v"))
    return rows.select("event_id", "raw_line", F.sha2(F.col("raw_line").cast("binary"), 256).alias("raw_sha256"), Field(F.col("v"), "k").as_type("bigint").alias("k"), is_object(F.col("v")).alias("is_object"))


def _customer_rules():
    c = F.col
    return [
        Rule("MISSING_NAME", c("c_name").isNull() | (c("c_name") == "")),
        Rule("NEGATIVE_BALANCE", c("c_acctbal") < 0),
        Rule("UNKNOWN_SEGMENT", ~c("c_mktsegment").isin("BUILDING", "MACHINERY", "AUTOMOBILE")),
        Rule("FAR_NATION", c("c_nationkey") >= 20),
    ]


_CUSTOMER_CODES = """list_filter([CASE WHEN c_name IS NULL OR c_name = '' THEN 'MISSING_NAME' END, CASE WHEN c_acctbal < 0 THEN 'NEGATIVE_BALANCE' END,
  CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') THEN 'UNKNOWN_SEGMENT' END, CASE WHEN c_nationkey >= 20 THEN 'FAR_NATION' END], lambda x: x IS NOT NULL)"""


@query(f"SELECT c_custkey, array_to_string({_CUSTOMER_CODES}, ',') AS reason_codes FROM customer")
def quality_reason_codes(read, spark):
    """All broken rules of a row, in the order of the table of rules."""
    return read("customer").select("c_custkey", F.array_join(reasons(_customer_rules()), ",").alias("reason_codes"))


@query(f"""
SELECT c_nationkey, count(*) AS bronze, count(*) FILTER (WHERE len({_CUSTOMER_CODES}) = 0) AS accepted, count(*) FILTER (WHERE len({_CUSTOMER_CODES}) > 0) AS quarantine
FROM customer GROUP BY c_nationkey
""")
def quarantine_split_counts(read, spark):
    """Accepted and rejected rows by group; together they are all rows."""
    rows = read("customer").withColumn("codes", reasons(_customer_rules()))
    return rows.groupBy("c_nationkey").agg(F.count("*").alias("bronze"), F.count_if(F.size("codes") == 0).alias("accepted"), F.count_if(F.size("codes") > 0).alias("quarantine"))


_LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
_LINE_LAST = "row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1"


def _last_lines(read):
    rows = read("lineitem").select("l_orderkey", "l_linenumber", *_LINE_ORDER, "l_quantity")
    return keep_last(rows, ["l_orderkey", "l_linenumber"], _LINE_ORDER)


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem QUALIFY {_LINE_LAST}")
def dedup_last_by_sequence(read, spark):
    """The last row of each natural key."""
    return _last_lines(read).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query("""
SELECT l_orderkey, l_linenumber, strftime(min(l_shipdate), '%Y-%m-%d') AS first_seen, strftime(max(l_shipdate), '%Y-%m-%d') AS last_seen
FROM lineitem GROUP BY l_orderkey, l_linenumber
""")
def dedup_first_seen_order(read, spark):
    """The last row of each key beside the place at which the key was first seen, which orders Silver."""
    kept = keep_last(read("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"], first_seen="l_shipdate")
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return kept.select("l_orderkey", "l_linenumber", day("first_seen").alias("first_seen"), day("l_shipdate").alias("last_seen"))


@query("""
WITH a AS (SELECT l_returnflag, count(*) AS accepted FROM lineitem GROUP BY 1),
k AS (SELECT l_returnflag, count(*) AS silver FROM (SELECT DISTINCT l_returnflag, l_orderkey, l_linenumber FROM lineitem) GROUP BY 1)
SELECT l_returnflag, accepted, silver, accepted - silver AS deduplicated FROM a JOIN k USING (l_returnflag)
""")
def dedup_accounting(read, spark):
    """Rows accepted, kept and dropped by source."""
    rows = read("lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_shipdate")
    return accounting(rows, keep_last(rows, ["l_returnflag", "l_orderkey", "l_linenumber"], ["l_shipdate"]), "l_returnflag")


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate + INTERVAL '2 hours 30 minutes' AS wall FROM lineitem),
o AS (SELECT *, timezone('Australia/Sydney', timezone('UTC', wall - INTERVAL 36 HOUR)) - (wall - INTERVAL 36 HOUR) AS o1,
                timezone('Australia/Sydney', timezone('UTC', wall + INTERVAL 36 HOUR)) - (wall + INTERVAL 36 HOUR) AS o2 FROM l),
c AS (SELECT *, list_distinct(list_filter([wall - o1, wall - o2], lambda u: timezone('Australia/Sydney', timezone('UTC', u)) = wall)) AS c FROM o)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN len(c) = 1 THEN strftime(c[1], '%Y-%m-%dT%H:%M:%SZ') END AS interval_utc,
       CASE WHEN len(c) = 1 THEN 'ok' WHEN len(c) = 0 THEN 'gap' ELSE 'fold' END AS verdict FROM c
""")
def local_to_utc_strict(read, spark):
    """Wall clocks to UTC; none for those in a gap, two for those in a fold."""
    from ..functions.time import utc_candidates

    rows = read("lineitem").withColumn("wall", F.col("l_shipdate").cast("timestamp") + F.expr("INTERVAL '02:30' HOUR TO MINUTE"))
    rows = rows.withColumn("found", utc_candidates(F.col("wall"), SYDNEY))
    n = F.size("found")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", utc_text(the_one(F.col("found"))).alias("interval_utc"), F.when(n == 1, "ok").when(n == 0, "gap").otherwise("fold").alias("verdict"))


@query("""
SELECT strftime(timezone('Australia/Sydney', timezone('UTC', ts)), '%Y-%m-%d') AS business_day, event_type, count(*) AS n, round(sum(value), 4) AS total
FROM events GROUP BY 1, 2
""")
def business_day_bucket(read, spark):
    """Totals by the date on the wall of the source's zone."""
    day = F.date_format(business_day(F.col("ts").cast("timestamp"), SYDNEY), "yyyy-MM-dd")
    return read("events").groupBy(day.alias("business_day"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query(f"""
WITH one AS (SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice FROM lineitem
             QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1)
SELECT o_orderkey, o_totalprice, l_partkey AS last_part, l_quantity AS last_quantity, l_extendedprice AS last_price, l_orderkey IS NOT NULL AS matched
FROM orders LEFT JOIN one ON o_orderkey = l_orderkey
""")
def enrich_left_join(read, spark):
    """Each order with its last line; orders without lines stay."""
    lines = read("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    out = lookup(read("orders").select("o_orderkey", "o_totalprice"), lines, ["o_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    return out.select("o_orderkey", "o_totalprice", F.col("l_partkey").alias("last_part"), F.col("l_quantity").alias("last_quantity"), F.col("l_extendedprice").alias("last_price"), F.col("matched").isNotNull().alias("matched"))


_REPORT = "QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY line DESC, v DESC, l_partkey DESC) = 1"


@query(f"""
WITH k AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_partkey, l_partkey * 100000 + l_suppkey AS line, CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS p, CAST(CAST(round(l_quantity * 100) AS BIGINT) AS VARCHAR) AS q FROM lineitem),
a AS (SELECT l_orderkey, l_linenumber, l_partkey, line, p AS v FROM k WHERE l_returnflag = 'A' {_REPORT}),
r AS (SELECT l_orderkey, l_linenumber, l_partkey, line, q AS v FROM k WHERE l_returnflag = 'R' {_REPORT})
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(a.v AS DOUBLE) AS price, CAST(r.v AS DOUBLE) AS demand, greatest(a.l_partkey, r.l_partkey) AS sequence FROM a JOIN r USING (l_orderkey, l_linenumber)
""")
def price_regionsum_join(read, spark):
    """Two kinds of records, the last of each by key, joined in one aggregation; a third kind is passed over."""
    text = lambda c: c.cast("string")
    cents = lambda c: text(F.round(F.col(c) * 100).cast("bigint"))
    report = F.when(F.col("l_returnflag") == "A", PRICE).when(F.col("l_returnflag") == "R", DEMAND).otherwise("OTHER")
    fields = {"SETTLEMENTDATE": text(F.col("l_orderkey")), "REGIONID": text(F.col("l_linenumber")), "DISPATCHINTERVAL": text(F.col("l_partkey")), "RRP": cents("l_extendedprice"), "TOTALDEMAND": cents("l_quantity")}
    values = F.create_map(*[x for name, v in fields.items() for x in (F.lit(name), v)])
    data = read("lineitem").select(F.lit("f").alias("source_file"), (F.col("l_partkey") * 100000 + F.col("l_suppkey")).alias("line"), report.alias("report"), F.lit("1").alias("version"), values.alias("values"))
    out = join_reports(data)
    return out.select(F.col("interval_datetime").cast("bigint").alias("l_orderkey"), F.col("region").cast("bigint").alias("l_linenumber"), F.col("price_per_mwh").alias("price"), F.col("demand_mw").alias("demand"), F.col("ingestion_sequence").alias("sequence"))


@query("""
WITH e AS (SELECT event_id AS line, CASE WHEN event_type = 'view' AND event_id % 7 = 0 THEN 'I' ELSE 'D' END AS kind, CAST(user_id % 10 AS VARCHAR) AS report, CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS cell FROM events),
c AS (SELECT *, last_value(CASE WHEN kind = 'I' THEN 'h' || CAST(line AS VARCHAR) END IGNORE NULLS) OVER (PARTITION BY report ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS header FROM e)
SELECT line, report, header, cell FROM c WHERE kind = 'D' AND header IS NOT NULL
""")
def multirecord_header_carry(read, spark):
    """Data rows under the last header row before them."""
    kind = F.when((F.col("event_type") == "view") & (F.col("event_id") % 7 == 0), "I").otherwise("D")
    report = (F.col("user_id") % 10).cast("string")
    cell = F.when(kind == "I", F.concat(F.lit("h"), F.col("event_id").cast("string"))).otherwise(F.round(F.col("value") * 100).cast("bigint").cast("string"))
    records = read("events").select(F.lit("f").alias("source_file"), F.col("event_id").alias("line"), F.array(kind, F.lit("G"), report, F.lit("1"), cell).alias("fields"))
    data = carry_headers(records)
    return data.select("line", "report", F.get(F.map_keys("values"), F.lit(0)).alias("header"), F.get(F.map_values("values"), F.lit(0)).alias("cell"))


@query("""
SELECT max(h || '.zip') AS href FROM (SELECT unnest(regexp_extract_all(html, 'href="(/[^"]*)"', 1)) AS h FROM pages) WHERE regexp_matches(h, '(?i)^/th')
""")
def latest_by_lexical_max(read, spark):
    """The lexically last of the links of all pages that match a pattern."""
    return newest_link(read("pages").select(F.regexp_replace("html", r'href="(/[^"]*)"', r'href="$1.zip"').alias("html")), "^/th")


@query(r"""SELECT max(h) AS href FROM (SELECT unnest(regexp_extract_all('<a href="/a/PUBLIC_DISPATCHIS_' || page_id || '.zip">', 'href="([^"]+\.zip)"', 1)) AS h FROM pages)""")
def newest_archive_link(read, spark):
    """The newest archive of a table of listings."""
    listing = read("pages").select(F.concat(F.lit('<a href="/a/PUBLIC_DISPATCHIS_'), F.col("page_id").cast("string"), F.lit('.zip">')).alias("html"))
    return newest_link(listing, r"PUBLIC_DISPATCHIS_.*\.zip$")


@query("""
SELECT 'customer' AS source_id, c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal, NULL FROM supplier
""")
def union_layers(read, spark):
    """Rows of differing sources in one layer."""
    c = read("customer").select(F.lit("customer").alias("source_id"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = read("supplier").select(F.lit("supplier").alias("source_id"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return c.unionByName(s, allowMissingColumns=True)


@query("""
WITH a AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 1000 = 7 THEN 'X' ELSE o_orderstatus END AS s FROM orders), b AS (SELECT o_orderkey, o_custkey, o_orderstatus AS s FROM orders),
d AS (SELECT 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'right' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))
SELECT side, count(*) AS n FROM d GROUP BY side
""")
def replay_diff(read, spark):
    """What a replay has beyond the first run, and the reverse."""
    b = read("orders").select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("s"))
    a = b.withColumn("s", F.when(F.col("o_orderkey") % 1000 == 7, "X").otherwise(F.col("s")))
    return difference(a, b).groupBy("side").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'F')")
def orphan_keys(read, spark):
    """Rows whose key has no parent."""
    child = read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return orphans(child, read("orders").filter("o_orderstatus = 'F'").select("o_orderkey"), {"l_orderkey": "o_orderkey"})


@query("""
WITH a AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 10 <> 3), b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 1 THEN 0 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 10 <> 4)
SELECT count(*) FILTER (WHERE a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL) AS in_both, count(*) FILTER (WHERE b.o_orderkey IS NULL) AS only_left,
       count(*) FILTER (WHERE a.o_orderkey IS NULL) AS only_right, count(*) FILTER (WHERE a.o_totalprice = b.o_totalprice) AS equal_rows
FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey
""")
def sync_reconcile(read, spark):
    """Keys and rows of a synced copy against its source."""
    o = read("orders").select("o_orderkey", "o_totalprice")
    b = o.filter("o_orderkey % 10 <> 4").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 100 == 1, F.lit(0.0)).otherwise(F.col("o_totalprice")))
    return reconcile(o.filter("o_orderkey % 10 <> 3"), b, ["o_orderkey"])


@query("""
WITH n AS (SELECT s_suppkey + 50 AS s_suppkey, 'new ' || s_name AS s_name, 1 AS s_nationkey, s_acctbal + 1 AS s_acctbal FROM supplier)
SELECT coalesce(o.s_suppkey, n.s_suppkey) AS s_suppkey, coalesce(n.s_name, o.s_name) AS s_name, CASE WHEN o.s_suppkey IS NULL THEN n.s_nationkey ELSE o.s_nationkey END AS s_nationkey,
       round(coalesce(n.s_acctbal, o.s_acctbal), 2) AS s_acctbal, CASE WHEN n.s_suppkey IS NOT NULL THEN 'loader' ELSE 'seed' END AS updated_by
FROM supplier o FULL JOIN n ON o.s_suppkey = n.s_suppkey
""")
def upsert_sources(read, spark):
    """Insert or replace by key; one column stays as it was, another names the writer."""
    old = read("supplier").withColumn("updated_by", F.lit("seed"))
    new = read("supplier").select((F.col("s_suppkey") + 50).alias("s_suppkey"), F.concat(F.lit("new "), "s_name").alias("s_name"), F.lit(1).alias("s_nationkey"), (F.col("s_acctbal") + 1).alias("s_acctbal"))
    return upsert(old, new, ["s_suppkey"], ["s_nationkey"], {"updated_by": F.lit("loader")}).withColumn("s_acctbal", F.round("s_acctbal", 2))


@query("SELECT o_orderkey, o_custkey FROM orders UNION ALL SELECT k, c FROM (SELECT o_orderkey + 1000 AS k, min(o_custkey) AS c FROM orders GROUP BY 1) WHERE k NOT IN (SELECT o_orderkey FROM orders)")
def insert_if_absent(read, spark):
    """Rows whose key is new."""
    old = read("orders").select("o_orderkey", "o_custkey")
    new = old.groupBy((F.col("o_orderkey") + 1000).alias("o_orderkey")).agg(F.min("o_custkey").alias("o_custkey"))
    return insert_absent(old, new, ["o_orderkey"])


@query("""
SELECT n_regionkey, '[' || string_agg('{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}', ',' ORDER BY n_nationkey) || ']' AS payload, count(*) AS rows
FROM nation GROUP BY n_regionkey
""")
def snapshot_json(read, spark):
    """Rows of a group as one JSON array, in order of the key."""
    return ordered_json(read("nation"), "n_nationkey", ["n_nationkey", "n_name"], ["n_regionkey"])


@query("SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders WHERE o_orderstatus = 'F' ORDER BY orders.o_orderdate DESC, o_orderkey LIMIT 25")
def recent_runs_topk(read, spark):
    """The most recent rows of a state; the limit is the report's."""
    top = recent(read("orders"), 25, at="o_orderdate", key="o_orderkey", state="o_orderstatus", status="F")
    return top.select("o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))


_FLAGGED = """
h AS (SELECT event_id, event_type, ts, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS demand,
  quantile_cont(value, 0.5) OVER w AS med, count(value) OVER w AS n FROM events
  WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND INTERVAL 1 SECOND PRECEDING)),
f AS (SELECT *, value > 300 AS by_value, coalesce(n >= 12 AND value > 5 * med AND value > 0, false) AS by_median FROM h)"""


_NAMES = {"region": "event_type", "at": "ts", "price": "value"}


def _intervals(read):
    return read("events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), "value", F.get_json_object("props", "$.k").cast("double").alias("demand"))


def _flagged(read):
    return spikes.flag(_intervals(read), **_NAMES)


@query(f"""
WITH {_FLAGGED}
SELECT event_id, by_value OR by_median AS is_spike, CASE WHEN by_value THEN 'absolute' WHEN by_median THEN 'relative' END AS spike_rule,
       round(CASE WHEN by_value THEN 300 WHEN by_median THEN 5 * med END, 6) AS spike_threshold,
       CASE WHEN by_value OR by_median THEN CASE WHEN value > 5000 THEN 'extreme' WHEN value > 1000 THEN 'high' WHEN value > 300 THEN 'warn' END END AS spike_severity FROM f
""")
def spike_flags(read, spark):
    """Spikes by an absolute threshold and by the trailing median."""
    return _flagged(read).select("event_id", "is_spike", "spike_rule", F.round("spike_threshold", 6).alias("spike_threshold"), "spike_severity")


_DAILY = f"""
WITH {_FLAGGED},
d AS (SELECT *, strftime(timezone('Australia/Sydney', timezone('UTC', ts)), '%Y-%m-%d') AS business_day, value * demand AS spend FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type, business_day ORDER BY value DESC, ts, demand) AS rn FROM d)
SELECT event_type, business_day, count(*) FILTER (WHERE by_value OR by_median) AS spike_interval_count, 5 * count(*) FILTER (WHERE by_value OR by_median) AS spike_minutes,
       max(value) AS max_price_per_mwh, strftime(min(ts) FILTER (WHERE rn = 1), '%Y-%m-%d %H:%M:%S') AS max_price_interval, round(sum(spend) / nullif(sum(demand), 0), 6) AS vwap_per_mwh,
       round(CASE WHEN sum(spend) > 0 THEN coalesce(sum(spend) FILTER (WHERE rn <= 10), 0) / sum(spend) END, 6) AS top10_interval_spend_share, count(*) FILTER (WHERE value < 0) AS negative_price_interval_count
FROM r GROUP BY event_type, business_day"""


def _daily(flagged):
    daily = spikes.daily_metrics(flagged, SYDNEY, **_NAMES, demand="demand")
    return daily.withColumns({"business_day": F.date_format("business_day", "yyyy-MM-dd"), "max_price_interval": F.date_format("max_price_interval", "yyyy-MM-dd HH:mm:ss"), "vwap_per_mwh": F.round("vwap_per_mwh", 6), "top10_interval_spend_share": F.round("top10_interval_spend_share", 6)})


@query(_DAILY)
def spike_daily_metrics(read, spark):
    """Spikes, extremes, volume-weighted price and spend shares by region and business day."""
    return _daily(_flagged(read))


@query(f"""
WITH m AS ({_DAILY}), {_FLAGGED.strip()}
SELECT CAST((SELECT sum(spike_interval_count) FROM m) AS BIGINT) AS by_day, (SELECT count(*) FROM f WHERE by_value OR by_median) AS by_row
""")
def spike_reconciliation(read, spark):
    """Spikes counted by day and by row: a run refuses to publish where they differ."""
    flagged = _flagged(read)
    by_row = flagged.agg(F.count_if("is_spike").alias("n"))
    return _daily(flagged).agg(F.sum("spike_interval_count").alias("by_day")).withColumn("by_row", by_row.scalar())


@query(f"SELECT event_type, business_day, top10_interval_spend_share FROM ({_DAILY})")
def top10_spend_share(read, spark):
    """The share of a day's spend in its ten dearest intervals."""
    # flags have no part in it
    plain = _intervals(read).withColumn("is_spike", F.lit(False))
    return _daily(plain).select("event_type", "business_day", "top10_interval_spend_share")


@query("SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice * l_quantity) / nullif(sum(l_quantity), 0), 4) AS vwap, count(*) AS n FROM lineitem GROUP BY 1, 2")
def vwap_by_key(read, spark):
    """Volume-weighted average price."""
    p, q = F.col("l_extendedprice"), F.col("l_quantity")
    return read("lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.round(spikes.vwap(p, q), 4).alias("vwap"), F.count("*").alias("n"))


@query("""
SELECT event_type, strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS latest, CAST(date_diff('second', date_trunc('second', max(ts)), TIMESTAMP '2024-03-01 00:00:00') AS BIGINT) AS lag_seconds
FROM events GROUP BY event_type
""")
def freshness_lag(read, spark):
    """The latest event of each source and how far it lies behind the run."""
    out = freshness(read("events"), ["event_type"], "ts", F.lit("2024-03-01 00:00:00"))
    return out.select("event_type", F.date_format("latest", "yyyy-MM-dd'T'HH:mm:ss").alias("latest"), "lag_seconds")


@query(f"WITH {_FLAGGED} SELECT event_type, count(*) AS spikes FROM f WHERE (by_value OR by_median) AND ts >= TIMESTAMP '2024-01-22' AND ts < TIMESTAMP '2024-01-29' GROUP BY 1 ORDER BY spikes DESC, event_type LIMIT 1")
def benchmark_top_region(read, spark):
    """The region with the most spikes in a week; the limit is the question's."""
    return spikes.top_region(_intervals(read), "2024-01-22", "2024-01-29", **_NAMES)


@query("""
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, max(value) AS max_value, strftime(arg_max(ts, struct_pack(v := value, t := -epoch_us(ts))), '%Y-%m-%dT%H:%M:%S') AS max_at
FROM events GROUP BY 1, 2
""")
def highest_interval(read, spark):
    """The highest value of each day and when it occurred; of equal ones the earliest."""
    rows = spikes.highest_interval(_intervals(read), F.date_format("ts", "yyyy-MM-dd"), **_NAMES)
    return rows.select("day", F.col("region").alias("event_type"), F.col("max_price").alias("max_value"), F.date_format("max_at", "yyyy-MM-dd'T'HH:mm:ss").alias("max_at"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spike metrics by region and business day: validation, windows and aggregation in one plan."""
    return QUERIES["spike_daily_metrics"](spark, sf_dir)


QUERIES |= catalog_runs.QUERIES
ORACLES |= catalog_runs.ORACLES
