"""Ingestion: file names, header rows, sheets and prepared tables."""

CATEGORY = """CASE WHEN contains(lower({n}), 'primer_anho') THEN 'matriculados_primer_anho'
    WHEN contains(lower({n}), 'admitidos') THEN 'admitidos' WHEN contains(lower({n}), 'inscritos') THEN 'inscritos'
    WHEN contains(lower({n}), 'matriculados') THEN 'matriculados' WHEN contains(lower({n}), 'docentes') THEN 'docentes'
    WHEN contains(lower({n}), 'graduados') THEN 'graduados' ELSE 'unknown' END"""
YEAR = """CASE WHEN contains({n}, '2001-2017') THEN '2001_2017' ELSE nullif(regexp_extract({n}, '(20\\d{{2}})', 1), '') END"""

FILES = """WITH f AS (
  SELECT o_orderkey, 'estudiantes_'
         || (['Admitidos', 'INSCRITOS', 'Matriculados', 'matriculados_primer_anho', 'docentes', 'Graduados', 'otros'])[o_orderkey % 7 + 1]
         || CASE o_orderkey % 5 WHEN 0 THEN '_sin_fecha' WHEN 1 THEN '_2001-2017' ELSE '_' || (year(o_orderdate) + 15) END
         || '.csv' AS filename FROM orders)
"""

SHEETS = r"""WITH tx AS (
  SELECT doc_id, text, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS ls FROM documents
), ln AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS r FROM tx
), cl AS (
  SELECT doc_id, r, unnest(string_split(line, ' ')) AS cell, unnest(range(len(string_split(line, ' ')))) AS pos FROM ln
), rated AS (
  SELECT doc_id, r, count(*) FILTER (regexp_matches(f, 'the|her|tion') OR f = 'a') AS score,
         count(*) FILTER (regexp_matches(cell, '\S')) / count(*) AS density
  FROM (SELECT *, translate(lower(trim(cell, ' ')), 'áéíóúñ', 'aeioun') AS f FROM cl WHERE r < 20) GROUP BY ALL
), head AS (
  SELECT doc_id, r AS header_row, score, density FROM rated
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, density DESC, r) = 1
), names AS (
  SELECT doc_id, pos, name FROM (
    SELECT cl.doc_id, pos, regexp_replace(cell, '^\s+|\s+$', '', 'g') AS name
    FROM cl JOIN head ON cl.doc_id = head.doc_id AND cl.r = head.header_row)
  WHERE name <> '' AND NOT starts_with(lower(name), 'unnamed')
), body AS (
  SELECT cl.doc_id, r, name, nullif(cell, '') AS value
  FROM cl JOIN head ON cl.doc_id = head.doc_id AND cl.r > head.header_row
  JOIN names ON names.doc_id = cl.doc_id AND names.pos = cl.pos
), recs AS (
  SELECT doc_id, r FROM body GROUP BY ALL HAVING count(value) > 0
), sizes AS (
  SELECT head.doc_id, header_row, coalesce(nc, 0) AS n_columns, coalesce(nr, 0) AS n_records, coalesce(fn, '') AS names
  FROM head
  LEFT JOIN (SELECT doc_id, count(*) AS nc, array_to_string(list(name ORDER BY pos), '|') AS fn
             FROM names GROUP BY doc_id) USING (doc_id)
  LEFT JOIN (SELECT doc_id, count(*) AS nr FROM recs GROUP BY doc_id) USING (doc_id)
), prepared AS (
  SELECT sizes.*, CASE WHEN NOT regexp_matches(text, '\S') THEN 'skipped_empty'
                       WHEN n_columns < 5 OR n_records = 0 THEN 'skipped_insufficient_data' ELSE 'success' END AS status
  FROM sizes JOIN documents USING (doc_id)
), sheet_scores AS (
  SELECT doc_id, source, lang, CAST(sum(score) AS BIGINT) AS score
  FROM rated JOIN documents USING (doc_id) GROUP BY ALL
), best AS (
  SELECT source, lang, doc_id, CASE WHEN n = 1 THEN 0 ELSE score END AS score, n AS n_sheets
  FROM (SELECT *, count(*) OVER (PARTITION BY source, lang) AS n,
               row_number() OVER (PARTITION BY source, lang ORDER BY score DESC, doc_id) AS k FROM sheet_scores)
  WHERE k = 1
)
"""

HEADERS = """WITH h AS (
  SELECT o_orderstatus AS status, o_orderkey % 10 AS k FROM orders)
"""
CANONICAL = ["CÓDIGO DE LA INSTITUCIÓN", "CÓDIGO SNIES DEL PROGRAMA", "ADMITIDOS", "MODALIDAD", "ID ÁREA", "SEXO",
             "AÑO", "NUM DE DOCENTES", "NÚCLEO BÁSICO DEL CONOCIMIENTO (NBC)", "Columna rara"]
KEYS = ["codigo de la institucion", "codigo snies del programa", "admitdos 2015", "metodologia", "id_area", "genero",
        "ano*", "no. de docentes", "nucleo basico del conocimiento", "columna rara"]


def pick(values: list[str]) -> str:
    return "([" + ", ".join(f"'{v}'" for v in values) + "])[k + 1]"


PIVOTED = ["admitidos", "inscritos", "matriculados", "matriculados_primer_anho", "docentes"]

ORACLES = {
    "file_names": FILES + f"SELECT o_orderkey, filename, {CATEGORY.format(n='filename')} AS category, "
                          f"{YEAR.format(n='filename')} AS year FROM f",
    "page_years": f"SELECT page_id, {CATEGORY.format(n='url')} AS category, {YEAR.format(n='url')} AS year FROM pages",
    "file_discovery": """
        SELECT DISTINCT CASE o_orderstatus WHEN 'F' THEN 'graduados' WHEN 'O' THEN 'inscritos' ELSE 'otros' END
               || '_' || (year(o_orderdate) + 15) AS folder,
               CASE o_orderstatus WHEN 'F' THEN 'graduados' WHEN 'O' THEN 'inscritos' ELSE 'unknown' END AS category,
               CAST(year(o_orderdate) + 15 AS VARCHAR) AS year FROM orders""",
    "pending_files": """
        SELECT category, CAST(year AS INTEGER) AS year, category || '_' || year || '.csv' AS filename FROM (
          SELECT o_orderstatus AS category, year(o_orderdate) AS year FROM orders
          EXCEPT SELECT l_linestatus, year(l_shipdate) FROM lineitem WHERE year(l_shipdate) <= 1998)""",
    "header_row": SHEETS + "SELECT doc_id, header_row, score, density FROM head",
    "data_sheet": SHEETS + "SELECT source, lang, doc_id, score, n_sheets FROM best",
    "promote_header": SHEETS + "SELECT doc_id, status, header_row, n_columns, n_records, names FROM prepared",
    "sheet_records": SHEETS + """
        SELECT doc_id, name, count(*) AS n_cells, count(value) AS n_values
        FROM body JOIN recs USING (doc_id, r) JOIN prepared USING (doc_id) WHERE status = 'success' GROUP BY ALL""",
    "quoted_sheets": """
        SELECT CAST(p_partkey AS VARCHAR) AS key,
               CASE p_partkey % 4 WHEN 0 THEN p_name || ';' || p_type WHEN 1 THEN p_name || chr(10) || p_type
                                  WHEN 2 THEN p_name || ' "' || p_type || '"' ELSE p_name END AS name,
               CAST(p_size AS VARCHAR) AS size, CAST(NULL AS VARCHAR) AS empty, '5" x' AS plain, p_brand FROM part""",
    "repatch_languages": SHEETS + """
        , good AS (  -- a workbook whose best sheet gives no table keeps the one it has
          SELECT source, lang, doc_id FROM best JOIN prepared USING (doc_id) WHERE lang = 'en' AND status = 'success')
        , chosen AS (
          SELECT source, lang, min(doc_id) AS doc_id FROM documents WHERE lang <> 'en' GROUP BY ALL
          UNION ALL SELECT source, lang, doc_id FROM good
          UNION ALL SELECT source, lang, min(doc_id) FROM documents WHERE lang = 'en' AND source NOT IN (SELECT source FROM good) GROUP BY ALL)
        SELECT source, doc_id, n_columns, n_records, lang FROM chosen JOIN prepared USING (doc_id) WHERE status = 'success'""",
    "fold_cells": """
        SELECT doc_id, md5(t) AS folded_md5, regexp_matches(t, 'cion|ethe|oun') OR t = 'a' AS mentions
        FROM (SELECT doc_id, translate(lower(trim(text, ' ')), 'áéíóúñ', 'aeioun') AS t FROM documents)""",
    "resolve_alias": HEADERS + f"SELECT status, {pick(CANONICAL)} AS canonical, count(*) AS n FROM h GROUP BY ALL",
    "header_keys": HEADERS + f"SELECT {pick(KEYS)} AS header_key, count(*) AS n FROM h GROUP BY ALL",
    "rename_columns": """
        SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_custkey WHEN o_orderkey % 3 <> 0 THEN o_custkey + 1 END AS code,
               o_totalprice AS "ADMITIDOS", o_orderkey AS "Nro orden" FROM orders""",
    "pivoted_skip": FILES + f"""
        , c AS (SELECT {CATEGORY.format(n='filename')} AS category, {YEAR.format(n='filename')} AS year FROM f)
        SELECT category, year, count(*) AS n FROM c
        WHERE NOT (year IS NOT NULL AND year = '2013' AND category IN ({', '.join(f"'{c}'" for c in PIVOTED)}))
        GROUP BY ALL""",
}
