"""Cleaning and profiling."""

from oracles.ingest import SHEETS

HOLES = """WITH h AS (
  SELECT CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS code,
         CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey END AS programme,
         CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS priority,
         CASE WHEN o_orderkey % 4 <> 0 THEN CAST(trunc(o_totalprice) AS BIGINT) END AS metric,
         CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS clerk,
         CAST(year(o_orderdate) AS INTEGER) AS year
  FROM orders)
"""

PRIORITY = """WITH d AS (
  SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '  ' || o_orderpriority WHEN 1 THEN lower(o_orderpriority)
                     WHEN 2 THEN o_orderpriority || ' ' || chr(9) ELSE 'None' END AS p FROM orders)
"""

MAPPED = """CASE {v} WHEN '1-urgent' THEN 'Urgent' WHEN '2-high' THEN 'High' WHEN '3-medium' THEN 'Medium'
            WHEN '5-low' THEN 'Low' ELSE {rest} END"""

DAILY = """WITH d AS (
  SELECT 'g' || (user_id % 3) AS category, CAST(day(ts) AS INTEGER) AS day, event_type AS col FROM events
  WHERE NOT (event_type = 'error' AND day(ts) % 2 = 0))
"""


def nulls(table: str, columns: list[str]) -> str:
    union = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS null_count, count(*) AS n FROM {table}"
        for c in columns)
    return f"""SELECT "column", null_count, round(null_count / n * 100, 2) AS null_pct
               FROM ({union}) WHERE null_count > 0"""


HOLE_COLUMNS = ["code", "programme", "priority", "metric", "clerk", "year"]
POLICY = """, p AS (SELECT code, programme, coalesce(priority, 'DESCONOCIDO') AS priority,
       coalesce(metric, 0) AS metric, clerk, year FROM h WHERE code IS NOT NULL AND programme IS NOT NULL)
"""

ORACLES = {
    "text_normalise": r"""
        WITH d AS (SELECT doc_id, text, CASE doc_id % 6 WHEN 0 THEN ' NaN ' WHEN 1 THEN 'none'
              WHEN 2 THEN '  ' || source || chr(9) WHEN 3 THEN source || chr(10) || 'b' || chr(13) || 'c '
              WHEN 4 THEN 'nan' || chr(10) ELSE chr(10) END AS s FROM documents)
        SELECT doc_id,
               CASE WHEN lower(trim(s, ' ')) NOT IN ('nan', 'none', 'null', '')
                    THEN trim(regexp_replace(s, '[\n\r\t]', ' ', 'g'), ' ') END AS source_text,
               CASE WHEN lower(trim(text, ' ')) NOT IN ('nan', 'none', 'null', '')
                    THEN md5(trim(regexp_replace(text, '[\n\r\t]', ' ', 'g'), ' ')) END AS text_md5
        FROM d""",
    "categorical_map": PRIORITY + r""", c AS (
        SELECT o_orderkey, CASE WHEN lower(trim(p, ' ')) NOT IN ('nan', 'none', 'null', '')
                           THEN trim(regexp_replace(p, '[\n\r\t]', ' ', 'g'), ' ') END AS v FROM d)
        SELECT o_orderkey, """ + MAPPED.format(v="lower(v)", rest="v") + " AS priority FROM c",
    "categorical_map_upper": PRIORITY + "SELECT o_orderkey, " + MAPPED.format(
        v="lower(trim(p, ' '))", rest="upper(trim(p, ' '))") + " AS priority FROM d",
    "cast_numeric": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 3 IN (0, 1) THEN CAST(year(o_orderdate) AS INTEGER) END AS year,
               CASE WHEN o_orderkey % 4 IN (0, 1, 2) THEN CAST(trunc(o_totalprice) AS BIGINT) END AS metric,
               CASE WHEN o_orderkey % 5 IN (2, 3, 4) THEN trunc(o_totalprice) + 0.5 END AS number
        FROM orders""",
    "code_cleanup": """
        SELECT CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_partkey AS VARCHAR) ELSE l_partkey || '.05' END AS code,
               count(*) AS n FROM lineitem GROUP BY 1""",
    "domain_check": """
        SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber IN (1, 2) THEN l_linenumber END AS semester,
               CASE WHEN year(l_shipdate) + 14 BETWEEN 2013 AND 2030 THEN CAST(year(l_shipdate) + 14 AS INTEGER) END AS year
        FROM lineitem""",
    "impute_unknown": HOLES + "SELECT * REPLACE (coalesce(priority, 'DESCONOCIDO') AS priority) FROM h",
    "impute_zero": HOLES + "SELECT * REPLACE (coalesce(metric, 0) AS metric) FROM h",
    "drop_null_keys": HOLES + "SELECT * FROM h WHERE code IS NOT NULL AND programme IS NOT NULL",
    "null_policy": HOLES + POLICY + "SELECT * FROM p",
    "drop_sparse_columns": HOLES + "SELECT code, programme, priority, metric, year FROM h",
    "analysis_ready": """
        SELECT CASE WHEN o_orderkey % 6 <> 0 THEN o_orderpriority ELSE 'DESCONOCIDO' END AS sector,
               CAST(year(o_orderdate) AS INTEGER) AS year, CAST(o_orderkey % 2 + 1 AS INTEGER) AS semester,
               count(*) AS n, CAST(sum(CASE WHEN o_orderkey % 8 <> 0 THEN trunc(o_totalprice) ELSE 0 END) AS BIGINT) AS total,
               CAST(4 AS BIGINT) AS n_columns
        FROM orders WHERE o_orderkey % 9 <> 0 AND o_orderkey % 5 <> 0 GROUP BY 1, 2, 3""",
    "canonical_align": """
        SELECT o_custkey AS code, CAST(NULL AS VARCHAR) AS parent, o_totalprice, o_orderkey AS extra, 'm' AS _origin,
               'code,parent,o_totalprice,extra,_origin' AS column_order FROM orders""",
    "rename_by_position": """
        SELECT n_nationkey AS code, n_name AS name, s_suppkey, s_acctbal AS metric
        FROM nation JOIN supplier ON n_nationkey = s_nationkey""",
    "label_truncate": """
        SELECT doc_id, substring(text, 1, 40) AS cut40,
               CASE WHEN length(text) > 25 THEN substring(text, 1, 25) || '...' ELSE text END AS cut25 FROM documents""",
    "null_counts": HOLES + "SELECT " + ", ".join(
        f"count(*) FILTER ({c} IS NULL) AS {c}" for c in HOLE_COLUMNS) + " FROM h",
    "null_report": HOLES + nulls("h", HOLE_COLUMNS),
    "null_report_after": HOLES + POLICY + nulls("p", HOLE_COLUMNS),
    "duplicate_profile": """
        SELECT count(*) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS distinct_rows,
               count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS duplicate_rows
        FROM documents""",
    "schema_drift": DAILY + """
        , t AS (SELECT category, count(DISTINCT day) AS n_years, count(DISTINCT col) AS n_columns FROM d GROUP BY category)
        , c AS (SELECT category, col, count(DISTINCT day) AS k,
                       array_to_string(list_sort(list(DISTINCT day)), ',') AS years FROM d GROUP BY ALL)
        SELECT category, col AS "column", k = n_years AS in_all_years, years, n_years, n_columns
        FROM c JOIN t USING (category)""",
    "schema_validation": DAILY + """
        , f AS (SELECT category, day, bool_or(col = 'view') v, bool_or(col = 'click') c, bool_or(col = 'error') e,
                       bool_or(col = 'purchase') p, bool_or(col = 'signup') s FROM d GROUP BY ALL)
        SELECT category, day, false AS valid,
               concat_ws(',', 'channel', CASE WHEN NOT c THEN 'click' END, CASE WHEN NOT e THEN 'error' END,
                         CASE WHEN NOT v THEN 'view' END) AS missing_required,
               'refund' AS missing_nullable,
               concat_ws(',', CASE WHEN p THEN 'purchase' END, CASE WHEN s THEN 'signup' END) AS unexpected
        FROM f""",
    "file_profile": """
        SELECT o_orderstatus AS category, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_rows,
               CASE k WHEN 2 THEN 'error' ELSE 'ok' END AS status, CAST([3, 2, 0][k + 1] AS BIGINT) AS n_cols,
               ['CÓDIGO SNIES DEL PROGRAMA|INSCRITOS|Cliente', 'Nota, libre|CÓDIGO SNIES DEL PROGRAMA', ''][k + 1] AS columns,
               ['Cliente', 'Nota, libre', ''][k + 1] AS non_canonical
        FROM (SELECT *, year(o_orderdate) % 3 AS k FROM orders) GROUP BY 1, 2, k""",
    "status_summary": SHEETS + """
        SELECT lang, status, count(*) AS n_files, CAST(sum(n_records) AS BIGINT) AS total_rows
        FROM prepared JOIN documents USING (doc_id) GROUP BY ALL""",
    "profile_totals": """
        WITH f AS (SELECT source, coalesce(max(toxic), 0) AS bad FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source)
        SELECT count(*) AS files_total, count(*) FILTER (bad = 0) AS files_ok, count(*) FILTER (bad > 0) AS files_error FROM f""",
}
