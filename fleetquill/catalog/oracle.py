"""The registered queries in SQL, over the same tables and the same stand-in mappings."""

from __future__ import annotations

from fleetquill.catalog import stored
from fleetquill.operators import dimensions

ORACLE_SQL: dict[str, str] = {}

# --- stand-ins ---------------------------------------------------------------------------

_ITEMS = """
items AS (
  SELECT * FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
)"""

_ERROR_FACT = f"""{_ITEMS},
error_fact AS (
  SELECT p_type AS model_desc, c_mktsegment AS brand, 'F' || (l_suppkey % 4) AS factory_name,
    r_name AS delivery_region_de, n_name AS delivery_country_de, p_size AS model_key_3,
    l_returnflag AS diagnosis_address, nullif(l_linestatus, 'F') AS diagnosis_address_text,
    CAST(l_partkey % 500 AS VARCHAR) AS dfcc, l_suppkey AS dtc,
    CAST(l_shipdate AS DATE) AS ecu_production_date_cur, p_brand AS factory_desc,
    p_name AS vehicle_model_de, l_linenumber AS sw_version,
    'M' || (l_suppkey % 10) AS manufacturer_name_concat, l_partkey % 50 AS hw_part_number,
    l_linenumber AS hw_version, l_suppkey AS hw_spare_part_number,
    CAST(floor(l_quantity) AS INTEGER) AS id_software_version,
    o_orderstatus AS maturity_level, l_returnflag AS online_status,
    o_orderpriority AS source_system, CAST(year(o_orderdate) AS INTEGER) AS model_year,
    l_linestatus = 'O' AS pivot_event_flag
  FROM items
)"""

_COMPLAINTS = """
complaint_daily AS (
  SELECT p_size AS model_key_3, c_mktsegment AS brand, 'F' || (l_suppkey % 4) AS factory_name,
    r_name AS delivery_region_de, n_name AS delivery_country_de,
    p_name || ' ' || o_orderstatus AS workshop_description_short,
    o_orderpriority AS repair_shop_fault_type_group, l_returnflag AS repair_shop_fault_type,
    p_brand AS repair_shop_fault_object_main_group, p_name AS repair_shop_fault_object_detail,
    p_name || ' ' || o_orderpriority AS customer_complaint_text,
    o_orderstatus AS customer_fault_object_main_group,
    CAST(l_shipdate AS DATE) AS complaint_date, CAST(o_orderdate AS DATE) AS delivery_date
  FROM items
)"""

_VEHICLES = """
vehicle_extended AS (
  SELECT CAST(o_orderkey % 50 + 1 AS INTEGER) AS model_key_3, c_mktsegment AS brand,
    CAST(o_orderdate AS DATE) AS zp8_date, 'F' || (o_orderkey % 4) AS factory_name,
    r_name AS delivery_region_de, n_name AS delivery_country_de
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

_BRIDGE = """
bridge AS (SELECT DISTINCT model_key_3, model_desc FROM error_fact)"""

# --- filter dimensions ---------------------------------------------------------------------

_MONTHS = """(12 * (year(complaint_date) - year(delivery_date))
    + month(complaint_date) - month(delivery_date)
    - CASE WHEN day(complaint_date) >= day(delivery_date)
             OR (complaint_date = last_day(complaint_date)
                 AND delivery_date = last_day(delivery_date))
           THEN 0 ELSE 1 END)"""

_DERIVED = {
    "ecu_name": "diagnosis_address || ' - ' || diagnosis_address_text",
    "dfcc_hex": "upper(hex(TRY_CAST(dfcc AS INTEGER)))",
    "months_diff": _MONTHS,
    "mis_label": f"CASE WHEN {_MONTHS} <= 48 THEN 'MIS ' || {_MONTHS} END",
    "zp8_date_start": "CAST(zp8_date AS VARCHAR)",
    "zp8_date_end": "CAST(zp8_date AS VARCHAR)",
}


def _expression(column: str) -> str:
    return f"{_DERIVED[column]} AS {column}" if column in _DERIVED else column


def _dimension_rows(dimension: dimensions.Dimension) -> str:
    columns = ", ".join(map(_expression, dimension.columns))
    if dimension.source == dimensions.ERROR_FACT:
        return f"SELECT DISTINCT {columns} FROM error_fact"
    return (
        f"SELECT DISTINCT {columns} FROM {dimension.source} JOIN bridge USING (model_key_3)"
    )


def _dimension_sql(dimension: dimensions.Dimension) -> str:
    ctes = {
        dimensions.ERROR_FACT: f"WITH {_ERROR_FACT}",
        dimensions.COMPLAINTS: f"WITH {_ERROR_FACT},{_COMPLAINTS},{_BRIDGE}",
        dimensions.VEHICLES: f"WITH {_ERROR_FACT},{_VEHICLES},{_BRIDGE}",
    }
    return f"{ctes[dimension.source]}\n{_dimension_rows(dimension)}"


for _d in dimensions.DIMENSIONS:
    ORACLE_SQL[_d.name] = _dimension_sql(_d)

ORACLE_SQL["dim_distinct_counts"] = (
    f"WITH {_ERROR_FACT},{_COMPLAINTS},{_VEHICLES},{_BRIDGE}\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{d.name}' AS dimension, count(*) AS tuples FROM ({_dimension_rows(d)})"
        for d in dimensions.DIMENSIONS
    )
)

ORACLE_SQL["ecu_name"] = f"""WITH {_ERROR_FACT}
SELECT diagnosis_address, diagnosis_address_text,
  diagnosis_address || ' - ' || diagnosis_address_text AS ecu_name, dtc
FROM error_fact"""

ORACLE_SQL["join_model_bridge"] = f"""WITH {_ERROR_FACT},{_VEHICLES},{_BRIDGE}
SELECT model_key_3, brand, zp8_date, factory_name, delivery_region_de, delivery_country_de,
  model_desc
FROM vehicle_extended JOIN bridge USING (model_key_3)"""

# --- core master data ------------------------------------------------------------------------

_LOADED = "DATE '2024-03-01' AS Load_Date, DATE '2039-03-01' AS KSU_LOESCH_DATUM"

_MODPROD_ROWS = """SELECT p_name AS {0},
  CASE WHEN p_partkey % 11 <> 0 THEN CAST(1990 + p_size AS VARCHAR) END AS {1},
  p_brand AS {2}, p_type AS {3}"""

ORACLE_SQL["scan_core_csv"] = (
    _MODPROD_ROWS.format("MODEL", "MODEL_YEAR", "SALES_CLASS", "PRODUCT") + " FROM part"
)

ORACLE_SQL["project_modprod"] = (
    _MODPROD_ROWS.format("Model", "Model_Year", "Sales_Class", "Product")
    + f", {_LOADED} FROM part"
)

_MODKPB_ROWS = """SELECT p_name AS Model, p_brand AS Sales_Class, p_type AS Product,
  CASE WHEN p_partkey % 11 <> 0 THEN 'K' || p_size END AS KPB"""

ORACLE_SQL["project_modkpb"] = f"{_MODKPB_ROWS}, {_LOADED} FROM part"

_INTERFACE = """interface AS (
  SELECT p_name AS modell, CAST(1990 + p_size AS VARCHAR) AS modelljahr,
    p_brand AS fahrzeugklasse,
    CASE WHEN p_partkey % 13 <> 0 THEN 'V' || (p_partkey % 700) END AS produktkennzeichen,
    p_type AS konzernprojektbezeichnung
  FROM part
)"""

ORACLE_SQL["positional_csv"] = f"WITH {_INTERFACE} SELECT * FROM interface"

ORACLE_SQL["distinct_product_ids"] = f"""WITH {_INTERFACE}
SELECT DISTINCT produktkennzeichen AS product_id FROM interface
WHERE produktkennzeichen IS NOT NULL"""

ORACLE_SQL["with_retention"] = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS Load_Date,
  CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 181 MONTH AS DATE) + INTERVAL 3 DAY AS DATE)
    AS KSU_LOESCH_DATUM
FROM orders"""

_FILES = """files AS (
  SELECT *, p_partkey // 50 AS file_no, (p_partkey // 50) % 5 AS kind,
    DATE '2024-01-01' + CAST((p_partkey // 50) % 20 AS INTEGER) AS folder,
    'core/' || CAST(DATE '2024-01-01' + CAST((p_partkey // 50) % 20 AS INTEGER) AS VARCHAR)
      || '/F' || (p_partkey // 50) AS path
  FROM part
)"""

ORACLE_SQL["classify_files"] = f"""WITH {_FILES}
SELECT DISTINCT path,
  CASE kind WHEN 0 THEN 'modprod' WHEN 1 THEN 'modkpb' END AS table_class
FROM files"""


def _merge_sql(names: list[str], batch_rows: str, nullable: str) -> str:
    """Distinct batch rows with the copies of their first file, minus the target, repeated."""
    columns = ", ".join([*names, "Load_Date", "KSU_LOESCH_DATUM"])
    same = " AND ".join(
        f"t.{c} = f.{c}" for c in [*names, "Load_Date", "KSU_LOESCH_DATUM"]
    )
    stored = ", ".join(
        f"CASE WHEN p_partkey % 3 = 0 THEN {n} || ' old' ELSE {n} END AS {n}"
        if n == "Product"
        else n
        for n in names
    )
    return f"""
WITH batch AS ({batch_rows}, p_partkey, p_partkey // 50 AS file_no, {_LOADED} FROM part),
target AS (
  SELECT {stored},
    CASE WHEN p_partkey % 2 = 0 THEN DATE '2024-03-01' ELSE DATE '2024-02-01' END AS Load_Date,
    CASE WHEN p_partkey % 2 = 0 THEN DATE '2039-03-01' ELSE DATE '2039-02-01' END
      AS KSU_LOESCH_DATUM
  FROM batch
),
per_file AS (SELECT {columns}, file_no, count(*) AS n FROM batch GROUP BY ALL),
firsts AS (
  SELECT {columns},
    CASE WHEN {nullable} IS NULL THEN sum(n) ELSE arg_min(n, file_no) END AS n
  FROM per_file GROUP BY {columns}
)
SELECT {columns} FROM target
UNION ALL
SELECT {columns} FROM (
  SELECT f.*, unnest(range(CAST(n AS BIGINT))) AS copy FROM firsts f
  WHERE NOT EXISTS (SELECT 1 FROM target t WHERE {same})
)"""


_PROD_NAMES = ["Model", "Model_Year", "Sales_Class", "Product"]
_KPB_NAMES = ["Model", "Sales_Class", "Product", "KPB"]
ORACLE_SQL["merge_modprod"] = _merge_sql(
    _PROD_NAMES, _MODPROD_ROWS.format(*_PROD_NAMES), "Model_Year"
)
ORACLE_SQL["merge_modkpb"] = _merge_sql(_KPB_NAMES, _MODKPB_ROWS, "KPB")

ORACLE_SQL["incremental_core_load"] = f"""
WITH {_FILES},
batch AS (
  SELECT p_name AS Model, CASE kind WHEN 0 THEN CAST(1990 + p_size AS VARCHAR) END AS Model_Year,
    p_brand AS Sales_Class, p_type AS Product, CASE kind WHEN 1 THEN 'K' || p_size END AS KPB,
    {_LOADED}, CASE kind WHEN 0 THEN 'modprod' ELSE 'modkpb' END AS table_class, path
  FROM files WHERE kind IN (0, 1) AND folder > DATE '2024-01-05'
),
per_file AS (SELECT *, count(*) AS n FROM batch GROUP BY ALL),
firsts AS (SELECT * EXCLUDE (path, n), arg_min(n, path) AS n FROM per_file GROUP BY ALL)
SELECT * EXCLUDE (n, copy) FROM (SELECT *, unnest(range(n)) AS copy FROM firsts)"""

_SALES = """entries AS (
  SELECT CAST(p_partkey AS VARCHAR) AS Produkt, p_name AS Beschreibung, p_brand AS Produkttyp,
    'ZA(' || (2000 + p_size) || '-' || (2000 + p_size + p_partkey % 4) || ')' AS entry,
    'ZA' AS series, 2000 + p_size AS start_year,
    CAST(2000 + p_size + p_partkey % 4 AS INTEGER) AS end_year
  FROM part
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), p_name, p_brand, 'ZB(' || (1990 + p_size) || ')', 'ZB',
    1990 + p_size, NULL
  FROM part
),
years AS (
  SELECT *, CAST(unnest(range(start_year, coalesce(end_year, start_year + 1))) AS INTEGER)
    AS modelljahr
  FROM entries
)"""

ORACLE_SQL["sales_class_entries"] = f"""WITH {_SALES}
SELECT Produkt, entry, series, start_year, end_year FROM entries"""
ORACLE_SQL["model_year_expansion"] = f"""WITH {_SALES}
SELECT Produkt, series, start_year, end_year, modelljahr FROM years"""
ORACLE_SQL["normalize_sales_class"] = f"""WITH {_SALES}
SELECT Produkt, Beschreibung, Produkttyp, series, {_LOADED}, modelljahr FROM years"""

# --- baselines -----------------------------------------------------------------------------

_DOCUMENTS = """documents_ AS (
  SELECT *, DATE '2024-01-01' + CAST((conv_id + turn) % 4 AS INTEGER) AS snapshot_date,
    'V' || conv_id AS productId,
    CASE conv_id % 3 WHEN 0 THEN 'Published' WHEN 1 THEN 'PUBLISHED' ELSE 'draft' END AS status
  FROM conversations
),
items AS (
  SELECT DISTINCT snapshot_date, productId, role, role || ': ' || text AS naming, m
  FROM (SELECT *, turn + unnest([0, 1]) AS m FROM documents_
        WHERE conv_id % 3 <> 2 AND conv_id % 5 <> 0)
),
addressed AS (
  SELECT *, unnest([role, 'A' || (m % 3)]) AS address FROM items
),
versioned AS (
  SELECT *, unnest(CASE WHEN m % 7 = 6 THEN [NULL] ELSE [m, m + 1] END) AS v FROM addressed
),
flat AS (
  SELECT 'P' || m AS partNumber, naming, 'T' || (m % 2) AS materialType,
    address AS diagnosisAddresses, 'H' || v AS hardwareVersion, 'S' || (v % 2) AS softwareVersion,
    CASE WHEN v IS NOT NULL THEN 'N' || m END AS hardwarePartNumber,
    CASE WHEN v % 4 <> 3 THEN 'F' || (v % 2) END AS abbreviation, productId, snapshot_date
  FROM versioned
),
stored AS (
  SELECT * EXCLUDE (snapshot_date), CAST(snapshot_date AS VARCHAR) AS validfrom,
    DATE '2039-03-01' AS KSU_LOESCH_DATUM
  FROM flat
)"""

_COMPLETE = "hardwareVersion IS NOT NULL AND abbreviation IS NOT NULL"

ORACLE_SQL["baseline_json_scan"] = f"""WITH {_DOCUMENTS}
SELECT productId, status, CAST(CASE WHEN conv_id % 5 = 0 THEN 0 WHEN turn % 7 = 1 THEN 3 ELSE 2 END AS INTEGER)
  AS materials, snapshot_date
FROM documents_"""
ORACLE_SQL["published_baselines"] = f"""WITH {_DOCUMENTS}
SELECT snapshot_date, productId, CAST(CASE WHEN conv_id % 5 = 0 THEN 0 WHEN turn % 7 = 1 THEN 3 ELSE 2 END AS INTEGER)
  AS materials
FROM documents_ WHERE upper(status) = 'PUBLISHED'"""
ORACLE_SQL["explode_materials"] = f"""WITH {_DOCUMENTS}
SELECT snapshot_date, productId, 'P' || m AS partNumber, naming,
  'T' || (m % 2) AS materialType, CAST(2 AS INTEGER) AS addresses
FROM items"""
ORACLE_SQL["flatten_baseline"] = f"WITH {_DOCUMENTS} SELECT * FROM stored"
ORACLE_SQL["baseline_complete_rows"] = f"""WITH {_DOCUMENTS}
SELECT DISTINCT * FROM stored WHERE {_COMPLETE}"""
ORACLE_SQL["baseline_rejected_rows"] = f"""WITH {_DOCUMENTS}
SELECT DISTINCT * FROM stored WHERE NOT ({_COMPLETE})"""
ORACLE_SQL["optional_path"] = f"""WITH {_DOCUMENTS}
SELECT snapshot_date, productId, naming, CAST(NULL AS VARCHAR) AS colour FROM items"""
ORACLE_SQL["baseline_first_seen"] = f"""WITH {_DOCUMENTS}
SELECT * EXCLUDE (snapshot_date),
  CASE WHEN min(snapshot_date) = (SELECT min(snapshot_date) FROM documents_)
       THEN '1600-01-01' ELSE CAST(min(snapshot_date) AS VARCHAR) END AS validfrom,
  DATE '2039-03-01' AS KSU_LOESCH_DATUM
FROM flat WHERE {_COMPLETE} GROUP BY ALL"""
ORACLE_SQL["merge_baseline_first_seen"] = f"""WITH {_DOCUMENTS}
SELECT * EXCLUDE (snapshot_date), CAST(min(snapshot_date) AS VARCHAR) AS validfrom,
  CASE WHEN min(snapshot_date) <= DATE '2024-01-02' THEN DATE '2039-02-01'
       ELSE DATE '2039-03-01' END AS KSU_LOESCH_DATUM
FROM flat WHERE {_COMPLETE} GROUP BY ALL"""
ORACLE_SQL["baseline_validity"] = """
SELECT conv_id, turn,
  CASE WHEN turn = 7 OR turn - 1 < 0 THEN NULL ELSE turn - 1 = 0 END AS valid
FROM conversations"""

# --- listings and moves ----------------------------------------------------------------------

_INBOX = """inbox AS (
  SELECT *, 'core/' || folder || '/' || name AS path, CAST(length(html) AS BIGINT) AS size
  FROM (
    SELECT *,
      CASE WHEN page_id % 17 = 0 THEN 'not-a-date'
           ELSE CAST(DATE '2024-01-01' + CAST(page_id % 20 AS INTEGER) AS VARCHAR) END AS folder,
      'Q' || (page_id // 3) || CASE page_id % 4 WHEN 0 THEN '.csv' WHEN 1 THEN ''
        WHEN 2 THEN '.txt'
        ELSE CASE WHEN page_id % 5 = 0 THEN '.dummy.csv' ELSE '.csv' END END AS name,
      DATE '2024-01-01' + CAST(page_id % 45 AS INTEGER) AS modified_at
    FROM pages
  )
)"""

_PLAN = f"""{_INBOX},
plan AS (
  SELECT path, modified_at, 'inbox' AS source_bucket, 'core/' || folder || '/' AS source_path,
    name AS source_file, 'landing' AS target_bucket,
    'core/' || replace(folder, '-', '/') || '/' AS target_path, target_file,
    'core/2024-03-01/' || target_file AS final_key,
    'core/core_duplicates/' || replace(folder, '-', '/') || '/' || target_file AS duplicate_key
  FROM (SELECT *, CASE WHEN name LIKE '%.csv' THEN name ELSE name || '.csv' END AS target_file
        FROM inbox)
  WHERE path NOT LIKE '%dummy%' AND regexp_matches(target_file, '\\.csv')
),
landed AS (
  SELECT 'core/2024-03-01/Q' || (page_id * 2) || '.csv' AS path FROM pages
  UNION
  SELECT 'core/' || replace(CAST(DATE '2024-01-01' + CAST(page_id % 20 AS INTEGER) AS VARCHAR), '-', '/')
    || '/Q' || (page_id // 3) || '.csv' FROM pages WHERE page_id % 2 = 0
),
marked AS (SELECT *, target_path || target_file IN (SELECT path FROM landed) AS is_duplicate FROM plan),
kept AS (
  SELECT 'core/core_duplicates/'
    || replace(CAST(DATE '2024-01-01' + CAST(page_id % 20 AS INTEGER) AS VARCHAR), '-', '/')
    || '/Q' || (page_id // 3) || '.csv'
    || unnest(['', CASE WHEN page_id % 2 = 0 THEN '_0' ELSE '_1' END,
               CASE WHEN page_id % 5 = 0 THEN '_2' ELSE '_01' END]) AS path
  FROM pages
),
numbered AS (
  SELECT plan.path, duplicate_key,
    CASE WHEN duplicate_key NOT IN (SELECT path FROM kept) THEN -1
         WHEN duplicate_key || '_0' NOT IN (SELECT path FROM kept) THEN 0
         WHEN duplicate_key || '_1' NOT IN (SELECT path FROM kept) THEN 1
         WHEN duplicate_key || '_2' NOT IN (SELECT path FROM kept) THEN 2
         ELSE 3 END AS version
  FROM plan
)"""

ORACLE_SQL["file_listing"] = f"""WITH {_INBOX}
SELECT path, size FROM inbox
WHERE (path LIKE 'core/2024-01-0%' OR path LIKE 'core/not%') AND path LIKE '%.csv'"""
ORACLE_SQL["file_pattern_filter"] = f"""WITH {_INBOX}
SELECT path, name AS target_file FROM inbox
WHERE path NOT LIKE '%dummy%' AND regexp_matches(name, '\\.csv')"""
ORACLE_SQL["snapshot_folders"] = f"WITH {_INBOX} SELECT DISTINCT folder FROM inbox"
ORACLE_SQL["newer_than_watermark"] = f"""WITH {_INBOX}
SELECT path, TRY_CAST(folder AS DATE) AS folder_date FROM inbox
WHERE TRY_CAST(folder AS DATE) > DATE '2024-01-05'"""
ORACLE_SQL["files_new_first"] = f"""WITH {_INBOX}
SELECT path, modified_at > DATE '2024-01-20' AS is_new FROM inbox ORDER BY is_new, path"""
ORACLE_SQL["move_plan"] = f"""WITH {_PLAN}
SELECT * EXCLUDE (path, modified_at) FROM plan"""
ORACLE_SQL["duplicate_targets"] = f"""WITH {_PLAN}
SELECT path, final_key, is_duplicate FROM marked"""
ORACLE_SQL["duplicate_versions"] = f"""WITH {_PLAN}
SELECT path, duplicate_key, CAST(version AS BIGINT) AS version FROM numbered"""
ORACLE_SQL["duplicate_strategy"] = f"""WITH {_PLAN}
SELECT s.strategy, m.path, CASE WHEN is_duplicate THEN s.strategy ELSE 'move' END AS action,
  CASE WHEN NOT is_duplicate THEN final_key
       WHEN s.strategy = 'skip' THEN NULL
       WHEN s.strategy = 'overwrite' OR n.version = -1 THEN m.duplicate_key
       ELSE m.duplicate_key || '_' || n.version END AS write_key
FROM marked m JOIN numbered n USING (path),
  (SELECT unnest(['skip', 'overwrite', 'version']) AS strategy) s"""
ORACLE_SQL["move_report"] = f"""WITH {_PLAN}
SELECT count(*) AS total, count(*) FILTER (WHERE is_duplicate) AS duplicates FROM marked"""

# --- responses ---------------------------------------------------------------------------------

_RESPONSES = """responses AS (
  SELECT url, 'u' || page_id AS uuid, 'V' || (page_id % 50) AS product_id,
    CAST(CASE page_id % 7 WHEN 0 THEN 404 WHEN 1 THEN 500 WHEN 2 THEN 403 WHEN 3 THEN 426
      ELSE 200 END AS INTEGER) AS status,
    CASE WHEN page_id % 2 = 0 THEN CAST(json_object('url', url, 'html', html) AS VARCHAR)
         ELSE html END AS body
  FROM pages
)"""

ORACLE_SQL["overview_uuids"] = """
SELECT product_id, 'u' || page_id || '-' || i AS uuid
FROM (SELECT page_id, 'V' || page_id AS product_id, unnest(range(page_id % 4)) AS i FROM pages)"""
ORACLE_SQL["raw_object_key"] = f"""WITH {_RESPONSES}
SELECT uuid, 'baselines/2024-03-01/' || product_id || '_2024-03-01_' || uuid AS object_key
FROM responses"""
ORACLE_SQL["request_urls"] = f"""WITH {_RESPONSES}
SELECT uuid,
  'https://example.invalid/products/' || product_id || '/baselines/v13' AS overview_url,
  'https://example.invalid/baselines/' || uuid || '/v13' AS baseline_url
FROM responses"""
ORACLE_SQL["json_validity"] = f"""WITH {_RESPONSES}
SELECT uuid, json_valid(body) AS is_json FROM responses"""
ORACLE_SQL["response_triage"] = f"""WITH {_RESPONSES}
SELECT uuid, status,
  CASE WHEN status IN (404, 426, 500) THEN 'skipped' WHEN status >= 400 THEN 'error'
       WHEN json_valid(body) THEN 'ok' ELSE 'invalid_json' END AS outcome
FROM responses"""
ORACLE_SQL["response_report"] = f"""WITH {_RESPONSES}
SELECT product_id, count(*) AS ids,
  count(*) FILTER (WHERE status NOT IN (404, 426, 500)) AS usable_ids,
  count(*) FILTER (WHERE status IN (404, 426, 500)) AS failed_ids
FROM responses GROUP BY product_id"""

# --- load log and maintenance --------------------------------------------------------------------

_LATEST = """latest AS (
  SELECT event_type AS table_name, CAST(max(ts) AS DATE) AS latest_load
  FROM events GROUP BY event_type
)"""

ORACLE_SQL["latest_load_per_table"] = f"WITH {_LATEST} SELECT * FROM latest"
ORACLE_SQL["min_watermark"] = f"""WITH {_LATEST}
SELECT min(latest_load) AS watermark FROM latest"""
ORACLE_SQL["effective_watermark"] = f"""WITH {_LATEST}
SELECT table_name, latest_load AS from_history, DATE '2024-02-02' AS from_date FROM latest
UNION ALL
SELECT n_name, DATE '1600-01-01', DATE '1600-01-01' FROM nation"""
ORACLE_SQL["maintenance_due"] = """
SELECT table_name, days, vacuum_last_run, vacuum_next_run
FROM (
  SELECT *, vacuum_last_run + days AS vacuum_next_run
  FROM (
    SELECT s_name AS table_name, CAST(s_suppkey % 30 AS INTEGER) AS days,
      s_suppkey % 5 <> 0 AS vacuum_flag,
      CASE WHEN s_suppkey % 7 <> 0
           THEN DATE '2024-01-01' + CAST(s_suppkey % 40 AS INTEGER) END AS vacuum_last_run
    FROM supplier
  )
)
WHERE vacuum_flag AND (vacuum_last_run IS NULL OR vacuum_next_run <= DATE '2024-02-01')"""
ORACLE_SQL["optimize_due"] = ORACLE_SQL["maintenance_due"].replace("vacuum_", "optimize_")

# --- through files ---------------------------------------------------------------------------

_DELIVERED = f"""parts AS (
  SELECT p_partkey AS k, p_name || ' ' || p_partkey AS Model, p_brand AS Sales_Class,
    p_type AS Product,
    CASE WHEN p_partkey % 11 <> 0 THEN CAST(1990 + p_size AS VARCHAR) END AS Model_Year,
    CASE WHEN p_partkey % 11 <> 0 THEN 'K' || p_size END AS KPB, {_LOADED}
  FROM part
),
deliveries AS (
  SELECT 1 AS load, 1 AS day, 'modprod' AS table_class, k, CASE k % 13 WHEN 0 THEN 2 ELSE 1 END AS n
  FROM parts WHERE k % 3 <> 0
  UNION ALL SELECT 1, 1, 'modkpb', k, 1 FROM parts WHERE k % 2 = 1
  UNION ALL SELECT 1, 2, 'modprod', k, 1 FROM parts WHERE k % 2 = 0
  UNION ALL SELECT 2, 3, unnest(['modprod', 'modkpb']), k, 1 FROM parts
),
loaded AS (
  SELECT load, table_class, k,
    CASE WHEN k % 11 = 0 THEN sum(n) ELSE arg_min(n, day) END AS n
  FROM deliveries GROUP BY load, table_class, k
),
kept AS (
  SELECT * FROM loaded l
  WHERE load = 1 OR k % 11 = 0 OR NOT EXISTS (
    SELECT 1 FROM loaded f WHERE f.load = 1 AND f.k = l.k AND f.table_class = l.table_class)
)"""

ORACLE_SQL["core_load_files"] = f"""WITH {_DELIVERED}
SELECT Model, CASE table_class WHEN 'modprod' THEN Model_Year END AS Model_Year, Sales_Class,
  Product, CASE table_class WHEN 'modkpb' THEN KPB END AS KPB, Load_Date, KSU_LOESCH_DATUM,
  table_class
FROM (SELECT *, unnest(range(CAST(n AS BIGINT))) AS copy FROM kept) JOIN parts USING (k)"""
ORACLE_SQL["core_stream_files"] = ORACLE_SQL["core_load_files"]
ORACLE_SQL["baseline_load_files"] = f"""WITH {_DOCUMENTS}
SELECT * EXCLUDE (snapshot_date),
  CASE min(snapshot_date) WHEN DATE '2024-01-01' THEN '1600-01-01'
       ELSE CAST(min(snapshot_date) AS VARCHAR) END AS validfrom,
  CASE WHEN min(snapshot_date) <= DATE '2024-01-02' THEN DATE '2039-02-01'
       ELSE DATE '2039-03-01' END AS KSU_LOESCH_DATUM
FROM flat WHERE {_COMPLETE} GROUP BY ALL"""
ORACLE_SQL["landed_responses"] = f"""WITH {_RESPONSES}
SELECT 'baselines/2024-03-01/' || product_id || '_2024-03-01_' || uuid AS object_key, product_id,
  uuid, json_extract_string(body, '$.url') AS url
FROM responses WHERE status < 400 AND json_valid(body)"""
ORACLE_SQL["core_csv_files"] = ORACLE_SQL["scan_core_csv"]
ORACLE_SQL["positional_csv_files"] = ORACLE_SQL["positional_csv"]
ORACLE_SQL["files_by_format"] = """
SELECT l_orderkey, l_linenumber, l_extendedprice, nullif(l_returnflag, 'N') AS l_returnflag,
  CAST(l_shipdate AS DATE) AS l_shipdate, file_format
FROM lineitem, (SELECT unnest(['csv', 'parquet']) AS file_format)"""
ORACLE_SQL["catalog_table"] = """
SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders"""
ORACLE_SQL["appended_tables"] = """
SELECT o_orderkey, o_totalprice,
  CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS note,
  ' a;"b",' || chr(10) || ' ' || o_orderpriority AS words,
  CAST(date_trunc('year', o_orderdate) AS DATE) AS Load_Date, table_format
FROM orders, (SELECT unnest(['parquet', 'csv', 'json']) AS table_format)"""
ORACLE_SQL["overwritten_tables"] = """
SELECT customer.*, writer, CAST(CASE writer WHEN 'files' THEN 3 ELSE 0 END AS BIGINT) AS files
FROM customer,
  (SELECT unnest(['compact', 'clustered', 'parquet', 'files', 'partitioned']) AS writer)"""
ORACLE_SQL["written_dimensions"] = (
    f"WITH {_ERROR_FACT},{_COMPLAINTS},{_VEHICLES},{_BRIDGE}\n"
    + "\nUNION ALL BY NAME\n".join(
        f"SELECT '{name}' AS dimension, * FROM ({_dimension_rows(dimensions.BY_NAME[name])})"
        for name in stored.WRITTEN_DIMENSIONS
    )
)
