"""The same questions as plain SQL, written independently of the Spark plans.

The record definitions repeat ``fixtures.py`` over the same tables.
"""

from __future__ import annotations

from shelfwatch.plans.catalog import LANDED_BEFORE, LATE_ABOVE, MIDDLE_DAY
from shelfwatch.plans.fixtures import OBS_CHAINS
from shelfwatch.sources.schemas import FACT_WIDTHS, PRICE_TAGS, RAW_PRICE, STORE_TAGS, TYPED_FACT, TYPED_PRICE

DEC = "DECIMAL(18,4)"
SQL_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "price": DEC, "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}

PRICES = f"""
prices AS (
  SELECT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%d.%m.%Y')
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS priceupdatedate,
         CAST(l_partkey AS VARCHAR) AS itemcode, '1' AS itemtype, p_name AS itemname,
         p_brand AS manufacturername, CAST(NULL AS VARCHAR) AS manufacturecountry,
         p_type AS manufactureritemdescription, CAST(NULL AS VARCHAR) AS unitqty,
         CAST(CAST(l_quantity AS {DEC}) AS VARCHAR) AS quantity, CAST(NULL AS VARCHAR) AS unitofmeasure,
         '0' AS bisweighted, CAST(p_size AS VARCHAR) AS qtyinpackage,
         CAST(CAST(l_extendedprice AS {DEC}) AS VARCHAR) AS itemprice,
         CAST(CAST(p_retailprice AS {DEC}) AS VARCHAR) AS unitofmeasureprice,
         CASE WHEN l_discount > 0 THEN '1' ELSE '0' END AS allowdiscount,
         l_returnflag AS itemstatus, CAST(NULL AS VARCHAR) AS itemid,
         CASE WHEN l_linestatus = 'F' THEN 'PriceFull' ELSE 'Price' END || num_reshet || '-' || num_snif
           || '-' || strftime(file_date, '%Y%m%d%H%M') || '.gz' AS file_name,
         num_reshet, num_snif, file_date, run_time
  FROM (SELECT l.*, CAST(s_nationkey AS VARCHAR) AS num_reshet, printf('%06d', l_suppkey) AS num_snif,
               l_shipdate + to_hours(CASE WHEN l_linestatus = 'F' THEN 3 ELSE l_linenumber + 6 END) AS file_date,
               l_shipdate + to_hours(20) AS run_time
        FROM lineitem l LEFT JOIN supplier ON s_suppkey = l_suppkey) x
  LEFT JOIN orders ON o_orderkey = l_orderkey
  LEFT JOIN part ON p_partkey = l_partkey)"""

ALL_CHAINS = """
chains AS (
  SELECT n_name AS reshet_name, CAST(n_nationkey AS BIGINT) AS reshet_num,
         'https://' || lower(r_name) || '.example' AS vendor_website
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""
# Those that some prices find no match in.
CHAINS = ALL_CHAINS.removesuffix(")") + " WHERE r_name <> 'EUROPE')"

ALL_STORES = """
stores AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS storeid, CAST(NULL AS VARCHAR) AS bikoretno, '1' AS storetype,
         s_name AS storename,
         CASE WHEN late AND s_acctbal >= 6000 THEN 'Avenue ' || s_suppkey
              WHEN s_acctbal >= 500 THEN 'Street ' || s_suppkey END AS address,
         n_name AS city,
         CASE WHEN s_acctbal < 2500 THEN 'unknown'
              WHEN s_acctbal >= 4000 THEN printf('%05d', s_suppkey) END AS zipcode,
         'Stores' || s_nationkey || '-' || strftime(stamp, '%Y%m%d%H%M') || '.xml' AS file_name,
         CAST(s_nationkey AS VARCHAR) AS num_reshet, stamp AS file_date, stamp AS run_time
  FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey,
       (VALUES (false, TIMESTAMP '1995-01-01 06:00:00'), (true, TIMESTAMP '2001-01-01 06:00:00')) d(late, stamp))"""
STORES = ALL_STORES.removesuffix(")") + " WHERE s_acctbal < 8000)"

STORE_DIM = """
store_rank AS (
  SELECT *, row_number() OVER (PARTITION BY num_reshet, storeid
    ORDER BY file_date DESC, file_name DESC, storename DESC NULLS LAST, address DESC NULLS LAST,
             city DESC NULLS LAST, zipcode DESC NULLS LAST) AS rn FROM stores),
store_dim AS (SELECT * EXCLUDE (rn) FROM store_rank WHERE rn = 1)"""

_CHAIN_CASE = " ".join(f"WHEN '{t}' THEN {n}" for t, n in OBS_CHAINS.items())
OBS = f"""
obs AS (
  SELECT event_id, user_id AS itemcode, 'item-' || event_id AS itemname,
         CAST(floor(value / 20) AS {DEC}) AS itemprice, ts AS file_date,
         CAST(CASE event_type {_CHAIN_CASE} END AS BIGINT) AS num_reshet, 1 AS num_snif,
         'PriceFull' || CAST(CASE event_type {_CHAIN_CASE} END AS BIGINT) || '-1-' || printf('%012d', event_id) AS file_name
  FROM events),
daily AS (
  SELECT itemcode, num_reshet, num_snif, itemname, itemprice, CAST(file_date AS DATE) AS day
  FROM (SELECT *, row_number() OVER (PARTITION BY itemcode, num_reshet, num_snif, CAST(file_date AS DATE)
          ORDER BY file_date DESC, file_name DESC) AS rn FROM obs) WHERE rn = 1)"""


def versions(source: str, name: str = "history") -> str:
    """History of a daily table: keep changes, end each at the next change, keep the first name."""
    key = "PARTITION BY itemcode, num_reshet, num_snif ORDER BY day"
    return f"""
{name} AS (
  SELECT itemcode, name_0 AS itemname, itemprice, day AS StartDate,
         lead(day) OVER ({key}) AS EndDate,
         CASE WHEN lead(day) OVER ({key}) IS NULL THEN 1 ELSE 0 END AS IsActive, num_reshet, num_snif
  FROM (SELECT *, lag(itemprice) OVER ({key}) AS p_0, first_value(itemname) OVER ({key}) AS name_0
        FROM {source})
  WHERE p_0 IS NULL OR itemprice <> p_0)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def _cast(column: str, type_name: str) -> str:
    return f"TRY_CAST({column} AS {SQL_TYPE[type_name]})"


def _typed(table: str, types: dict[str, str]) -> str:
    replaced = ", ".join(f"{_cast(c, t)} AS {c}" for c, t in types.items())
    return f"SELECT * REPLACE ({replaced}) FROM {table}"


def _per_column(table: str, tests: dict[str, str], measure: str, label: str = "column_name") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS {label}, count(*) AS n_rows, CAST(count(*) FILTER (WHERE {t}) AS BIGINT) AS {measure} FROM {table}"
        for c, t in tests.items()
    )


CALENDAR = """CAST(run_time AS DATE) AS snapshot, monthname(run_time) AS snapshot_month,
  strftime(run_time, '%Y') || ' - ' || quarter(run_time) AS snapshot_quarter,
  dayname(file_date) IN ('Friday', 'Saturday') AS is_weekend"""
DAYS = "CAST(date_diff('day', TRY_CAST(priceupdatedate AS DATE), CAST(file_date AS DATE)) AS INTEGER)"
JOINED = """prices p LEFT JOIN chains c ON TRY_CAST(p.num_reshet AS BIGINT) = c.reshet_num
  LEFT JOIN store_dim s ON p.num_reshet = s.num_reshet AND TRY_CAST(p.num_snif AS INTEGER) = TRY_CAST(s.storeid AS INTEGER)"""
FACT = f"""
fact AS (
  SELECT {CALENDAR.replace('run_time', 'p.run_time').replace('file_date', 'p.file_date')},
         TRY_CAST(itemcode AS BIGINT) AS itemcode, itemname, manufacturername, manufacturecountry,
         manufactureritemdescription, unitqty, unitofmeasure, qtyinpackage,
         TRY_CAST(itemprice AS {DEC}) AS itemprice, TRY_CAST(unitofmeasureprice AS {DEC}) AS unitofmeasureprice,
         TRY_CAST(allowdiscount AS BOOLEAN) AS allowdiscount, p.file_name,
         TRY_CAST(p.num_reshet AS BIGINT) AS num_reshet, TRY_CAST(priceupdatedate AS TIMESTAMP) AS priceupdatedate,
         p.file_date, p.run_time, TRY_CAST(num_snif AS INTEGER) AS num_snif,
         coalesce(reshet_name, 'Unknown') AS reshet_name, coalesce(storename, 'Unknown') AS storename,
         coalesce(address, 'Unknown') AS address, coalesce(city, 'Unknown') AS city,
         TRY_CAST(CASE WHEN zipcode = 'unknown' THEN '-999' ELSE zipcode END AS INTEGER) AS zipcode,
         {DAYS.replace('file_date', 'p.file_date')} AS days_since_last_price_update,
         CASE WHEN {DAYS.replace('file_date', 'p.file_date')} > 60 THEN 1 ELSE 0 END AS is_price_update_stale
  FROM {JOINED})"""
ALL_DIMS = [PRICES, CHAINS, STORES, STORE_DIM]

# Observations as raw price records, for the queries that enrich or land them.
RECORDS = f"""
prices AS (
  SELECT CAST(NULL AS VARCHAR) AS priceupdatedate, CAST(itemcode AS VARCHAR) AS itemcode, itemname,
         CAST(NULL AS VARCHAR) AS manufacturername, CAST(NULL AS VARCHAR) AS manufacturecountry,
         CAST(NULL AS VARCHAR) AS manufactureritemdescription, CAST(NULL AS VARCHAR) AS unitqty,
         CAST(NULL AS VARCHAR) AS unitofmeasure, CAST(NULL AS VARCHAR) AS qtyinpackage,
         CAST(itemprice AS VARCHAR) AS itemprice, CAST(NULL AS VARCHAR) AS unitofmeasureprice,
         CAST(NULL AS VARCHAR) AS allowdiscount, file_name, CAST(num_reshet AS VARCHAR) AS num_reshet,
         CAST(num_snif AS VARCHAR) AS num_snif, file_date, file_date AS run_time FROM obs)"""

# The observations' own chains and stores, of which one each is missing.
OBS_DIMS = [
    f"kinds AS (SELECT DISTINCT event_type, CAST(CASE event_type {_CHAIN_CASE} END AS BIGINT) AS code FROM events)",
    "chains AS (SELECT event_type AS reshet_name, code AS reshet_num FROM kinds WHERE event_type <> 'error')",
    """
store_dim AS (SELECT CAST(code AS VARCHAR) AS num_reshet, '001' AS storeid, upper(event_type[1]) || event_type[2:] AS storename,
                     CAST(NULL AS VARCHAR) AS address, 'Here' AS city, 'unknown' AS zipcode FROM kinds WHERE event_type <> 'signup')""",
]

HISTORY = [OBS, versions("daily")]
_ALL_VERSIONS = _with(*HISTORY) + "SELECT * FROM history"

BEFORE_AND_BATCH = [
    OBS,
    "newest AS (SELECT max(day) AS d FROM daily)",
    "before AS (SELECT * FROM daily WHERE day < (SELECT d FROM newest))",
    versions("before"),
    "batch AS (SELECT * FROM daily WHERE day = (SELECT d FROM newest))",
    """
matched AS (
  SELECT coalesce(b.itemcode, h.itemcode) AS itemcode, coalesce(b.num_reshet, h.num_reshet) AS num_reshet,
         coalesce(b.num_snif, h.num_snif) AS num_snif, h.itemname AS old_name, b.itemname AS new_name,
         h.itemprice AS old_price, b.itemprice AS new_price, h.StartDate AS old_start, b.day AS new_day,
         CASE WHEN h.itemprice IS NULL THEN 'NEW' WHEN b.itemprice IS NULL THEN 'OLD'
              WHEN h.itemprice <> b.itemprice THEN 'UPDATE' ELSE 'NO_CHANGE' END AS Action
  FROM batch b FULL JOIN (SELECT * FROM history WHERE IsActive = 1) h
    ON b.itemcode = h.itemcode AND b.num_reshet = h.num_reshet AND b.num_snif = h.num_snif)""",
]

_DAMAGED = f"""
damaged AS (
  SELECT event_id AS "offset", event_type, CASE WHEN event_type = 'error' THEN left(v, length(v) - 1) ELSE v END AS value,
         user_id, price
  FROM (SELECT *, '{{' || CASE WHEN event_type = 'view' THEN '' ELSE '"itemcode":"' || user_id || '",' END
          || '"itemprice":"' || price || '"}}' AS v
        FROM (SELECT *, CASE WHEN event_type = 'signup' THEN 'n/a' ELSE CAST(CAST(value AS {DEC}) AS VARCHAR) END AS price
              FROM events)))"""
_REASON = """CASE WHEN event_type = 'error' THEN 'unreadable' WHEN event_type = 'view' THEN 'no_key'
  WHEN event_type = 'signup' THEN 'bad_price' END"""

_DOCUMENTS = """
documents AS (
  SELECT CASE WHEN starts_with(file_name, 'PriceFull') THEN 'PriceFull' ELSE 'Price' END || num_reshet || '-' || num_snif
           || '-199901010300.gz' AS file_name, s_acctbal < 0 AS bad, allowdiscount, itemstatus
  FROM prices JOIN supplier ON s_suppkey = CAST(num_snif AS BIGINT))"""

_UNESCAPED = "substr(q, 2, length(q) - 2)"
for _ref, _char in [("&quot;", '"'), ("&#39;", "''"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")]:
    _UNESCAPED = f"replace({_UNESCAPED}, '{_ref}', '{_char}')"

_SNAPSHOTS = "rows_ AS (SELECT itemcode, file_name, itemprice, run_time, CAST(run_time AS DATE) AS snapshot FROM prices)"
_CUTOFF = "(SELECT max(snapshot) - 7 FROM rows_)"

_NAMES = "names AS (SELECT file_name FROM prices UNION SELECT file_name FROM stores)"
_LANDED = """CASE WHEN starts_with(file_name, 'Price') THEN replace(file_name, '.gz', '.parquet')
  ELSE replace(file_name, '.xml', '.parquet') END"""
_TARGET = "CASE WHEN starts_with(file_name, 'Price') THEN 'prices' ELSE 'snifim' END"



def _json(columns: list[str]) -> str:
    """A record as JSON text, null fields left out."""
    times = ("file_date", "run_time")
    shown = [f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%fZ')" if c in times else c for c in columns]
    fields = ", ".join(f"'\"{c}\":\"' || {x} || '\"'" for c, x in zip(columns, shown))
    return f"'{{' || array_to_string(list_filter([{fields}], lambda x: x IS NOT NULL), ',') || '}}'"


ORACLES: dict[str, str] = {
    "price_fact": _with(*ALL_DIMS, FACT) + "SELECT * FROM fact",
    "calendar_attrs": _with(PRICES) + f"SELECT itemcode, file_name, file_date, run_time, {CALENDAR} FROM prices",
    "join_chain": _with(*ALL_DIMS)
    + """SELECT itemcode, file_name, num_reshet, reshet_name
         FROM prices LEFT JOIN chains ON TRY_CAST(num_reshet AS BIGINT) = reshet_num""",
    "join_store": _with(*ALL_DIMS)
    + f"""SELECT itemcode, p.file_name, p.num_reshet, TRY_CAST(num_snif AS INTEGER) AS num_snif,
                 storename, address, city, zipcode FROM {JOINED}""",
    "staleness": _with(PRICES)
    + f"""SELECT itemcode, priceupdatedate, file_date, {DAYS} AS days_since_last_price_update,
                 CASE WHEN {DAYS} > 60 THEN 1 ELSE 0 END AS is_price_update_stale FROM prices""",
    "default_fill": _with(*ALL_DIMS)
    + f"""SELECT itemcode, p.file_name, p.num_reshet, TRY_CAST(num_snif AS INTEGER) AS num_snif,
                 coalesce(reshet_name, 'Unknown') AS reshet_name, coalesce(storename, 'Unknown') AS storename,
                 coalesce(address, 'Unknown') AS address, coalesce(city, 'Unknown') AS city FROM {JOINED}""",
    "zip_sentinel": _with(ALL_STORES)
    + """SELECT storeid, file_name, zipcode,
                CASE WHEN zipcode = 'unknown' THEN -999 ELSE TRY_CAST(zipcode AS INTEGER) END AS zip_number FROM stores""",
    "typed_projection": _with(PRICES) + _typed("prices", TYPED_PRICE),
    "typed_stores": _with(ALL_STORES)
    + _typed("stores", {"storeid": "int", "bikoretno": "int", "storetype": "int", "num_reshet": "bigint"}),
    "json_encode": _with(PRICES) + f"SELECT {_json(RAW_PRICE.names)} AS value FROM prices",
    "backfill_messages": _with(ALL_STORES)
    + """SELECT '{"storeid":"' || storeid || '","storetype":"' || storetype || '","storename":"' || storename || '"'
           || coalesce(',"address":"' || address || '"', '') || ',"city":"' || city || '"'
           || coalesce(',"zipcode":"' || zipcode || '"', '') || ',"file_name":"' || file_name || '","num_reshet":"' || num_reshet
           || '","file_date":"' || strftime(file_date, '%Y-%m-%dT%H:%M:%S.%fZ')
           || '","run_time":"' || strftime(run_time, '%Y-%m-%dT%H:%M:%S.%fZ') || '"}' AS value FROM stores""",
    "json_decode": """SELECT TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, 'prices' AS topic,
           CAST(event_id % 4 AS INTEGER) AS "partition", event_id AS "offset" FROM events""",
    "filename_attrs": _with(PRICES, ALL_STORES, _NAMES)
    + f"""SELECT file_name,
            replace(replace(replace(split_part(file_name, '-', 1), 'PriceFull', ''), 'Price', ''), 'Stores', '') AS num_reshet,
            CASE WHEN starts_with(file_name, 'Price') THEN split_part(file_name, '-', 2) END AS num_snif,
            strptime(CASE WHEN starts_with(file_name, 'Price') THEN replace(split_part(file_name, '-', 3), '.gz', '')
                     ELSE replace(split_part(file_name, '-', 2), '.xml', '') END, '%Y%m%d%H%M') AS file_date,
            {_LANDED} AS landed_name, {_TARGET} AS target FROM names""",
    "scan_parquet_schema": "SELECT l_orderkey, l_partkey, l_shipdate, CAST(NULL AS VARCHAR) AS l_comment FROM lineitem",
    "filter_full_files": _with(PRICES)
    + """SELECT itemcode, itemprice, file_name, num_reshet, num_snif, file_date FROM prices
         WHERE starts_with(file_name, 'PriceFull') AND num_reshet = '15'""",
    "latest_per_day": _with(PRICES)
    + """SELECT * EXCLUDE (rn) FROM (
           SELECT *, CAST(file_date AS DATE) AS file_day,
                  row_number() OVER (PARTITION BY itemcode, num_reshet, num_snif, CAST(file_date AS DATE)
                    ORDER BY file_date DESC, file_name DESC, itemprice DESC, itemname DESC) AS rn FROM prices) WHERE rn = 1""",
    "store_dedup": _with(ALL_STORES, STORE_DIM) + "SELECT * FROM store_dim",
    "store_dedup_rows": _with(ALL_STORES)
    + "SELECT DISTINCT num_reshet, storeid, storename, address, city, zipcode FROM stores",
    "dup_audit": _with(PRICES)
    + """SELECT count(file_name) AS n_names, count(DISTINCT file_name) AS n_distinct,
                count(file_name) - count(DISTINCT file_name) AS n_duplicates FROM prices""",
    "scd2_build": _ALL_VERSIONS,
    "scd2_merge": _ALL_VERSIONS,
    "scd2_late": _ALL_VERSIONS,
    "versioned_replace": _ALL_VERSIONS,
    "stream_scd2": _ALL_VERSIONS,
    "scd2_full_files": _with(
        PRICES,
        f"""
daily AS (
  SELECT itemcode, num_reshet, num_snif, itemname, itemprice, day FROM (
    SELECT CAST(itemcode AS BIGINT) AS itemcode, CAST(num_reshet AS BIGINT) AS num_reshet,
           CAST(num_snif AS INTEGER) AS num_snif, itemname, CAST(itemprice AS {DEC}) AS itemprice,
           CAST(file_date AS DATE) AS day,
           row_number() OVER (PARTITION BY itemcode, num_reshet, num_snif, CAST(file_date AS DATE)
             ORDER BY file_date DESC, file_name DESC, CAST(itemprice AS {DEC}) DESC, itemname DESC) AS rn
    FROM prices WHERE starts_with(file_name, 'PriceFull')) WHERE rn = 1)""",
        versions("daily"),
    )
    + "SELECT * FROM history",
    "scd2_classify": _with(*BEFORE_AND_BATCH)
    + "SELECT itemcode, num_reshet, num_snif, old_price, new_price, Action FROM matched",
    "scd2_apply": _with(*BEFORE_AND_BATCH)
    + """SELECT itemcode, CASE WHEN Action = 'NEW' THEN new_name ELSE old_name END AS itemname,
                CASE WHEN Action = 'NEW' THEN new_price ELSE old_price END AS itemprice,
                CASE WHEN Action = 'NEW' THEN new_day ELSE old_start END AS StartDate,
                CASE WHEN Action = 'UPDATE' THEN new_day END AS EndDate,
                CASE WHEN Action = 'UPDATE' THEN 0 ELSE 1 END AS IsActive, num_reshet, num_snif, Action FROM matched
         UNION ALL
         SELECT itemcode, old_name, new_price, new_day, NULL, 1, num_reshet, num_snif, 'UPDATE-open'
         FROM matched WHERE Action = 'UPDATE'
         UNION ALL
         SELECT *, 'close' FROM history WHERE IsActive = 0""",
    "scd2_current": _ALL_VERSIONS + " WHERE IsActive = 1",
    "scd2_closed": _ALL_VERSIONS + " WHERE IsActive = 0",
    "scd2_as_of": _with(*HISTORY)
    + """SELECT o.event_id, o.itemcode, o.num_reshet, o.num_snif, CAST(o.file_date AS DATE) AS as_of,
                h.itemname, h.itemprice, h.StartDate, h.EndDate
         FROM obs o LEFT JOIN history h ON o.itemcode = h.itemcode AND o.num_reshet = h.num_reshet
          AND o.num_snif = h.num_snif AND h.StartDate <= CAST(o.file_date AS DATE)
          AND (h.EndDate IS NULL OR CAST(o.file_date AS DATE) < h.EndDate)""",
    "scd2_valid_on": _ALL_VERSIONS
    + f" WHERE StartDate <= DATE '{MIDDLE_DAY}' AND (EndDate IS NULL OR EndDate > DATE '{MIDDLE_DAY}')",
    "retention_keep": _with(PRICES, _SNAPSHOTS)
    + f"SELECT * FROM rows_ WHERE snapshot IS NULL OR snapshot > {_CUTOFF}",
    "retention_expired": _with(PRICES, _SNAPSHOTS) + f"SELECT * FROM rows_ WHERE snapshot <= {_CUTOFF}",
    "retention_metrics": _with(PRICES, _SNAPSHOTS)
    + f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE snapshot <= {_CUTOFF}) AS n_expired,
                 count(*) FILTER (WHERE snapshot IS NULL OR snapshot > {_CUTOFF}) AS n_kept FROM rows_""",
    "archive_partitions": _with(OBS)
    + """SELECT event_id, itemcode, itemprice, CAST(file_date AS DATE) AS snapshot,
                CASE WHEN CAST(file_date AS DATE) <= (SELECT CAST(max(file_date) AS DATE) - 7 FROM obs)
                     THEN 'archive' ELSE 'live' END AS place FROM obs""",
    "compact_files": _with(OBS)
    + """SELECT event_id, itemcode, itemname, itemprice, file_date, num_reshet, num_snif, file_name, CAST(file_date AS DATE) AS snapshot,
                2 * count(*) AS n FROM obs GROUP BY ALL""",
    "sink_partitioned_fact": _with(OBS, RECORDS, *OBS_DIMS, FACT) + "SELECT * FROM fact",
    "external_table_sql": _with(PRICES)
    + f"""SELECT num_reshet, count(*) AS n_prices, count(DISTINCT itemcode) AS n_items,
                 CAST(sum(CAST(itemprice AS {DEC})) AS DECIMAL(28,4)) AS total_price FROM prices GROUP BY num_reshet""",
    "xml_items": _with(PRICES) + f"SELECT {', '.join(PRICE_TAGS)}, num_reshet FROM prices",
    "xml_stores_utf16": _with(ALL_STORES) + f"SELECT {', '.join(STORE_TAGS)} FROM stores",
    "page_links": rf"""
WITH tags AS (SELECT page_id, regexp_extract_all(html, '(?is)<a\s[^>]*>') AS t FROM pages),
one AS (SELECT page_id, CAST(unnest(range(len(t))) AS INTEGER) AS position, unnest(t) AS tag FROM tags),
quoted AS (SELECT page_id, position, regexp_extract(tag, '(?is)\shref\s*=\s*("[^"]*"|''[^'']*'')', 1) AS q FROM one),
links AS (SELECT page_id, position, {_UNESCAPED} AS link FROM quoted WHERE q <> '')
SELECT * FROM links WHERE starts_with(link, '/')""",
    "file_manifest": _with(PRICES)
    + """SELECT file_name, count(*) AS n_rows, min(file_date) AS first_date, max(file_date) AS last_date
         FROM prices GROUP BY file_name""",
    "new_files_anti": _with(PRICES)
    + f"""SELECT DISTINCT {_LANDED} AS landed_name, file_name, {_TARGET} AS target FROM prices
          WHERE file_date >= TIMESTAMP '{LANDED_BEFORE}'""",
    "ingest_quarantine": _with(_DAMAGED)
    + f"""SELECT "offset", {_REASON} AS reason, value FROM damaged WHERE {_REASON} IS NOT NULL""",
    "ingest_good": _with(_DAMAGED)
    + f"""SELECT "offset", CAST(user_id AS VARCHAR) AS itemcode, price AS itemprice FROM damaged WHERE {_REASON} IS NULL""",
    "dim_chain_load": _with(ALL_CHAINS) + "SELECT *, TIMESTAMP '2024-12-01 20:00:00' AS run_time FROM chains",
    "coverage_missing": _with(PRICES, ALL_STORES)
    + """, expected AS (SELECT DISTINCT num_reshet, CAST(storeid AS INTEGER) AS num_snif FROM stores),
         days AS (SELECT CAST(unnest(generate_series(min(CAST(file_date AS DATE)), max(CAST(file_date AS DATE)), INTERVAL 1 DAY)) AS DATE) AS day FROM prices)
         SELECT num_reshet, num_snif, day FROM expected, days
         EXCEPT SELECT num_reshet, CAST(num_snif AS INTEGER), CAST(file_date AS DATE) FROM prices""",
    "coverage_gaps": _with(PRICES, ALL_STORES)
    + """, expected AS (SELECT DISTINCT num_reshet, CAST(storeid AS INTEGER) AS num_snif FROM stores),
         span AS (SELECT min(CAST(file_date AS DATE)) AS a, max(CAST(file_date AS DATE)) AS b FROM prices),
         missing AS (
           SELECT num_reshet, num_snif, CAST(d AS DATE) AS day
           FROM expected, span, LATERAL (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY)) AS d) x
           EXCEPT SELECT num_reshet, CAST(num_snif AS INTEGER), CAST(file_date AS DATE) FROM prices),
         runs AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY num_reshet, num_snif ORDER BY day) AS INTEGER) AS run FROM missing)
         SELECT num_reshet, num_snif, min(day) AS first_day, max(day) AS last_day, CAST(count(*) AS INTEGER) AS n_days
         FROM runs GROUP BY num_reshet, num_snif, run""",
    "dq_cast_failures": _with(PRICES)
    + _per_column(
        "prices",
        {
            c: f"{c} IS NOT NULL AND {_cast(c, t)} IS NULL"
            for c, t in {**TYPED_PRICE, **TYPED_FACT}.items()
            if c != "zipcode"
        },
        "n_failures",
    ),
    "dq_unmatched_dims": _with(*ALL_DIMS, f"joined AS (SELECT reshet_name, storename FROM {JOINED})")
    + _per_column("joined", {"chain": "reshet_name IS NULL", "store": "storename IS NULL"}, "n_unmatched", "dimension"),
    "dq_varchar_overflow": _with(*ALL_DIMS, FACT)
    + _per_column(
        "fact",
        {c: f"length({c}) > {n}" for c, n in {**FACT_WIDTHS, "file_name": 30, "itemname": 10}.items()},
        "n_too_long",
    ),
    "dq_scd2_invariants": _with(*HISTORY)
    + """SELECT count(DISTINCT (itemcode, num_reshet, num_snif)) AS n_entities, count(*) AS n_versions,
                CAST((SELECT count(*) FROM (SELECT 1 FROM history GROUP BY itemcode, num_reshet, num_snif
                      HAVING count(*) FILTER (WHERE IsActive = 1) <> 1)) AS BIGINT) AS n_not_one_active,
                count(*) FILTER (WHERE (EndDate IS NULL) <> (IsActive = 1)) AS n_open_mismatch,
                count(*) FILTER (WHERE EndDate <= StartDate) AS n_empty_interval,
                CAST((SELECT count(*) FROM history a JOIN history b ON a.itemcode = b.itemcode AND a.num_reshet = b.num_reshet
                      AND a.num_snif = b.num_snif AND a.StartDate < b.StartDate
                      AND (a.EndDate IS NULL OR b.StartDate < a.EndDate)) AS BIGINT) AS n_overlaps FROM history""",
    "batch_metrics": _with(PRICES)
    + """SELECT count(*) AS n_rows, count(DISTINCT file_name) AS n_files, min(file_date) AS first_date,
                max(file_date) AS last_date FROM prices""",
    "offset_progress": """SELECT 'prices' AS topic, CAST(event_id % 4 AS INTEGER) AS "partition",
           max(event_id) AS latest_offset FROM events GROUP BY ALL""",
    "offset_audit": """
WITH log AS (SELECT CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS o, event_type FROM events),
seen AS (SELECT DISTINCT "partition", o FROM log WHERE event_type <> 'purchase'),
gaps AS (SELECT "partition", o + 1 AS a, lead(o) OVER (PARTITION BY "partition" ORDER BY o) - 1 AS b FROM seen),
twice AS (SELECT "partition", o, o - row_number() OVER (PARTITION BY "partition" ORDER BY o) AS run
          FROM (SELECT DISTINCT "partition", o FROM log WHERE event_type = 'signup')),
found AS (
  SELECT "partition", 'lost' AS kind, a, b FROM gaps WHERE a <= b
  UNION ALL SELECT "partition", 'repeated', min(o), max(o) FROM twice GROUP BY "partition", run)
SELECT 'prices' AS topic, "partition", kind, a AS first_offset, b AS last_offset, b - a + 1 AS n_offsets FROM found""",
    "publish_outbox": _with(PRICES) + "SELECT *, 'prices' AS topic FROM prices",
    "stream_stores": _with(ALL_STORES, STORE_DIM) + "SELECT * EXCLUDE (run_time) FROM store_dim",
    "unknown_tags": _with(PRICES, _DOCUMENTS)
    + """SELECT file_name, 'pricebefore' AS tag, count(*) AS n_items FROM documents WHERE NOT bad AND allowdiscount = '1' GROUP BY file_name
         UNION ALL
         SELECT file_name, 'returnreason', count(*) FROM documents WHERE NOT bad AND itemstatus = 'R' GROUP BY file_name""",
    "ingest_bad_files": _with(PRICES, _DOCUMENTS)
    + """SELECT file_name, CASE WHEN bad THEN 'not_gzip' END AS reason, CASE WHEN NOT bad THEN count(*) END AS n_rows
         FROM documents GROUP BY file_name, bad""",
    "stream_two_sinks": _with(OBS, RECORDS, *OBS_DIMS, FACT)
    + """SELECT 'fact' AS consumer, file_name, CAST(itemcode AS VARCHAR) AS itemcode, CAST(itemprice AS VARCHAR) AS itemprice, file_date,
                reshet_name, storename FROM fact
         UNION ALL SELECT 'parsed', file_name, itemcode, itemprice, file_date, NULL, NULL FROM prices""",
    "stream_dedup": _with(OBS)
    + """SELECT file_name, CAST(itemcode AS VARCHAR) AS itemcode, CAST(itemprice AS VARCHAR) AS itemprice,
                CAST(num_reshet AS VARCHAR) AS num_reshet, file_date FROM obs""",
}
ORACLES["stream_incremental"] = ORACLES["json_decode"]
