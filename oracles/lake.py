"""What the lake, CSV and JSON queries must give back."""

from oracles.reports import PANEL

ORDERS = """WITH o AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
         CAST(year(o_orderdate) AS INTEGER) AS order_year,
         CASE o_orderstatus WHEN 'F' THEN 'graduados' WHEN 'O' THEN 'inscritos' ELSE 'matriculados' END AS category
  FROM orders)
"""

ORACLES = {
    "lake_roundtrip": ORDERS + "SELECT * EXCLUDE (category) FROM o",
    "lake_year_filter": ORDERS + "SELECT o_orderkey, o_totalprice, order_year FROM o WHERE order_year IN (1996, 1999)",
    "lake_write_report": ORDERS + """
        SELECT category, 'success' AS status, count(*) AS n_rows,
               CAST(count(DISTINCT order_year) AS INTEGER) AS n_years FROM o GROUP BY category""",
    "lake_integrity": ORDERS + """
        SELECT category, 'ok' AS status, count(DISTINCT order_year) AS n_years, count(*) AS total_rows,
               array_to_string(list_sort(list(DISTINCT order_year)), ',') AS years FROM o GROUP BY category""",
    "lake_multi_read": ORDERS + """
        SELECT category, order_year, count(*) AS n, max(o_totalprice) AS top_price
        FROM o WHERE order_year IN (1997, 1998) GROUP BY ALL""",
    "lake_append_idempotent": ORDERS + """
        SELECT order_year, count(*) AS n, count(DISTINCT o_orderkey) AS n_orders FROM o GROUP BY order_year""",
    "csv_roundtrip": PANEL + "SELECT * FROM ratios",
    "csv_latin1_positional": """
        SELECT 'Institución Nº ' || o_custkey AS "NOMBRE_IES", CAST(year(o_orderdate) AS DOUBLE) AS year,
               count(*) FILTER (o_orderkey % 10 <> 0) AS n_codes, count(*) AS n,
               count(*) FILTER (o_orderkey % 7 <> 0) AS n_totals,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderkey % 7 <> 0) AS DOUBLE) AS total
        FROM orders GROUP BY ALL""",
    "report_json": ORDERS + "SELECT o_orderstatus, order_year, count(*) AS n FROM o GROUP BY ALL",
    "union_schema_evolution": ORDERS + """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, order_year,
               CASE WHEN order_year >= 1998 THEN o_orderpriority END AS o_orderpriority,
               CASE WHEN order_year > 2000 THEN 'c' || (o_custkey % 3) END AS channel FROM o""",
    "historical_merge": """
        WITH o AS (
          SELECT *, CAST(year(o_orderdate) AS INTEGER) AS y,
                 CASE o_orderstatus WHEN 'F' THEN 'graduados' WHEN 'O' THEN 'inscritos' ELSE 'matriculados' END AS category
          FROM orders
        ), kept AS (
          SELECT *, CASE WHEN y <= 1998 AND y + 17 >= 2013 THEN y + 17 WHEN y <= 1998 THEN NULL
                         WHEN y = 1999 THEN 2018 WHEN y = 2001 THEN 2019 ELSE 2013 END AS year FROM o
          WHERE y <= 1998 AND (category <> 'graduados' OR y + 17 BETWEEN 2013 AND 2017)
             OR y IN (1999, 2001) OR (y = 2000 AND category = 'graduados')
        )
        SELECT category, CAST(year AS INTEGER) AS year,
               CASE WHEN o_orderkey % 4 IN (1, 2) THEN CAST(o_orderkey % 4 AS INTEGER) END AS semester,
               CASE o_orderkey % 3 WHEN 0 THEN 'Privado' WHEN 1 THEN 'Oficial' ELSE 'Mixto' END AS sector,
               CASE WHEN o_orderkey % 5 = 0 THEN 'DESCONOCIDO' ELSE 'Prog ' || (o_orderkey % 13) END AS programme,
               count(*) AS n,
               CAST(sum(CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE trunc(o_totalprice) END) AS BIGINT) AS total,
               count(DISTINCT o_custkey) AS n_codes
        FROM kept WHERE o_orderkey % 11 <> 0 GROUP BY ALL""",
    "lake_append_adds": ORDERS + """
        SELECT order_year, count(*) AS n, count(DISTINCT o_orderkey) AS n_orders FROM o GROUP BY ALL""",
    "load_report": """
        WITH c(s, category) AS (VALUES ('F', 'graduados'), ('O', 'inscritos'), ('P', 'matriculados')),
        f(year) AS (VALUES ('2013'), ('2018'), ('2020')),
        t AS (SELECT *, CASE WHEN year = '2020' THEN 'error'
                             WHEN year = '2013' AND category <> 'graduados' THEN 'skipped' ELSE 'processed' END AS status FROM c, f)
        SELECT category, year, status, CASE WHEN status = 'processed' THEN
                 (SELECT count(*) FROM orders WHERE o_orderstatus = s AND o_orderkey % 11 <> 0) END AS n_rows FROM t""",
    "multi_year_range": """
        SELECT o_orderkey, CAST(year(o_orderdate) + 15 AS INTEGER) AS year, o_totalprice
        FROM orders WHERE year(o_orderdate) + 15 BETWEEN 2013 AND 2017""",
    "exported_cleaned": """
        WITH c(i, category, metric) AS (VALUES (0, 'admitidos', 'ADMITIDOS'), (1, 'docentes', 'NUM DE DOCENTES'),
               (2, 'graduados', 'GRADUADOS'), (3, 'inscritos', 'INSCRITOS'), (4, 'matriculados', 'MATRICULADOS'),
               (5, 'matriculados_primer_anho', 'MATRICULADOS PRIMER CURSO'))
        SELECT category, CASE WHEN category = 'docentes' THEN 'CÓDIGO DE LA INSTITUCIÓN|TIPO IES|SECTOR IES|PRINCIPAL O SECCIONAL|AÑO|NUM DE DOCENTES|CÓDIGO SNIES DEL PROGRAMA|PROGRAMA ACADÉMICO'
                              ELSE 'CÓDIGO DE LA INSTITUCIÓN|TIPO IES|SECTOR IES|PRINCIPAL O SECCIONAL|CÓDIGO SNIES DEL PROGRAMA|PROGRAMA ACADÉMICO|AÑO|' || metric END AS columns,
               count(*) AS n, CAST(sum(CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE trunc(o_totalprice) END) AS BIGINT) AS total,
               count(DISTINCT year(o_orderdate)) AS n_years, 0::BIGINT AS n_without_sector
        FROM orders JOIN c ON o_orderkey % 6 = i
        WHERE o_orderkey % 11 <> 0 AND year(o_orderdate) + 17 BETWEEN 2013 AND 2030 GROUP BY category, metric""",
}
