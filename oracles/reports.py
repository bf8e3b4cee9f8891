"""Panel and reports: the facts as separate tables and a left-join chain."""

PANEL = """
WITH li AS (
  SELECT *, CAST(year(l_shipdate) AS INTEGER) AS yr FROM lineitem
), sup AS (
  SELECT s_suppkey AS entity_id, s_name AS entity_name, r_name AS sector,
         CASE WHEN s_acctbal < 0 THEN 'overdrawn' ELSE 'funded' END AS character, n_name AS department
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), mat AS (SELECT l_suppkey k, yr, sum(l_quantity) v FROM li WHERE l_linestatus = 'F' GROUP BY ALL
), ins AS (SELECT l_suppkey k, yr, sum(l_quantity) v FROM li GROUP BY ALL
), adm AS (SELECT l_suppkey k, yr, sum(l_quantity) v FROM li WHERE l_linestatus = 'F' OR l_returnflag = 'R' GROUP BY ALL
), gra AS (SELECT l_suppkey k, yr, sum(l_quantity) v FROM li WHERE l_linestatus = 'F' AND l_returnflag = 'A' GROUP BY ALL
), fst AS (SELECT l_suppkey k, yr, sum(l_quantity) v FROM li WHERE l_linestatus = 'F' AND l_linenumber = 1 GROUP BY ALL
), stf AS (SELECT l_suppkey k, yr, CAST(count(DISTINCT l_partkey) AS DOUBLE) v FROM li
           WHERE l_returnflag = 'R' AND l_discount >= 0.10 GROUP BY ALL
), metrics AS (
  SELECT sup.*, mat.yr AS year, mat.v AS enrolled, coalesce(ins.v, 0.0) AS applicants,
         coalesce(adm.v, 0.0) AS admitted, coalesce(gra.v, 0.0) AS graduated,
         coalesce(fst.v, 0.0) AS first_year, coalesce(stf.v, 0.0) AS staff
  FROM mat JOIN sup ON sup.entity_id = mat.k
  LEFT JOIN ins ON ins.k = mat.k AND ins.yr = mat.yr
  LEFT JOIN adm ON adm.k = mat.k AND adm.yr = mat.yr
  LEFT JOIN gra ON gra.k = mat.k AND gra.yr = mat.yr
  LEFT JOIN fst ON fst.k = mat.k AND fst.yr = mat.yr
  LEFT JOIN stf ON stf.k = mat.k AND stf.yr = mat.yr
), ratios AS (
  SELECT *, CASE WHEN enrolled > 0 THEN graduated / enrolled END AS grad_rate,
         CASE WHEN applicants > 0 THEN enrolled / applicants END AS retention,
         CASE WHEN applicants > 0 THEN admitted / applicants END AS admission,
         CASE WHEN staff > 0 THEN enrolled / staff END AS staff_load,
         applicants - graduated AS gap
  FROM metrics
), lag1 AS (
  SELECT *, lag(enrolled) OVER (PARTITION BY entity_id ORDER BY year) AS prev_enrolled,
         lag(grad_rate) OVER (PARTITION BY entity_id ORDER BY year) AS prev_grad_rate
  FROM ratios
), lagged AS (
  SELECT * EXCLUDE (prev_enrolled),
         CASE WHEN prev_enrolled > 0 THEN (enrolled - prev_enrolled) / prev_enrolled END AS growth
  FROM lag1
), cuts AS (
  SELECT quantile_disc(grad_rate, 0.25) AS p25_grad, quantile_disc(grad_rate, 0.33) AS p33_grad,
         quantile_disc(retention, 0.33) AS p33_retention, quantile_disc(staff_load, 0.75) AS p75_load
  FROM lagged
), labelled AS (
  SELECT lagged.*, CAST(CASE WHEN grad_rate < p33_grad OR retention < p33_retention OR staff_load > p75_load
                             THEN 1 ELSE 0 END AS INTEGER) AS at_risk
  FROM lagged, cuts
)
"""

PROFILE = PANEL + """
, profile AS (
  SELECT entity_id, avg(staff_load) AS mean_load, avg(grad_rate) AS mean_rate, avg(enrolled) AS mean_enrolled
  FROM ratios GROUP BY entity_id HAVING avg(staff_load) < 1500 AND avg(grad_rate) < 2
), fit AS (
  SELECT count(*) AS n, regr_slope(mean_rate * 100, mean_load) AS slope,
         regr_intercept(mean_rate * 100, mean_load) AS intercept, corr(mean_load, mean_rate) AS r,
         min(mean_load) AS x_min, max(mean_load) AS x_max FROM profile
)
"""

CHANGE = PANEL + """
, change AS (
  SELECT department, avg(grad_rate) FILTER (year BETWEEN 1995 AND 1997) AS rate_before,
         avg(grad_rate) FILTER (year BETWEEN 1999 AND 2001) AS rate_after
  FROM ratios GROUP BY department
), changed AS (
  SELECT department, round(rate_before, 6) AS rate_before, round(rate_after, 6) AS rate_after,
         round((rate_after - rate_before) * 100, 6) AS change_pp
  FROM change WHERE rate_before IS NOT NULL AND rate_after IS NOT NULL
)
"""

ORACLES = {
    "panel_metrics": PANEL + "SELECT * FROM metrics",
    "panel_from_facts": PANEL + "SELECT * FROM metrics",
    "panel_from_stored": PANEL + "SELECT * FROM metrics",
    "fact_sums": PANEL + """
        SELECT sup.*, yr AS year, l_returnflag, sum(l_quantity) AS units
        FROM li JOIN sup ON l_suppkey = entity_id GROUP BY ALL""",
    "panel_ratios": PANEL + "SELECT * FROM ratios",
    "panel_growth": PANEL + "SELECT entity_id, year, enrolled, growth FROM lagged",
    "panel_prev_rate": PANEL + "SELECT entity_id, year, grad_rate, prev_grad_rate FROM lagged",
    "panel_thresholds": PANEL + "SELECT * FROM cuts",
    "panel_train_thresholds": PANEL + """
        SELECT quantile_disc(grad_rate, 0.25) AS p25_grad, quantile_disc(grad_rate, 0.33) AS p33_grad,
               quantile_disc(retention, 0.33) AS p33_retention, quantile_disc(staff_load, 0.75) AS p75_load
        FROM lagged WHERE year BETWEEN 1995 AND 1999""",
    "panel_risk_label": PANEL + "SELECT * FROM labelled",
    "complete_cases": PANEL + """
        SELECT * FROM lagged WHERE grad_rate IS NOT NULL AND prev_grad_rate IS NOT NULL
          AND staff_load IS NOT NULL AND growth IS NOT NULL AND retention IS NOT NULL
          AND enrolled IS NOT NULL AND gap IS NOT NULL""",
    "distinct_values": PANEL + "SELECT DISTINCT year, sector FROM metrics",
    "national_evolution": PANEL + """
        SELECT year, sum(applicants) AS applicants, sum(admitted) AS admitted, sum(enrolled) AS enrolled,
               sum(graduated) AS graduated,
               CASE WHEN sum(enrolled) > 0 THEN sum(graduated) * 100 / sum(enrolled) END AS grad_pct
        FROM ratios GROUP BY year""",
    "national_extrema": PANEL + """
        , e AS (SELECT year, sum(graduated) * 100 / sum(enrolled) AS v FROM ratios GROUP BY year
                HAVING sum(enrolled) > 0)
        SELECT (SELECT max(v) FROM e) AS max_value,
               (SELECT year FROM e ORDER BY v DESC, year LIMIT 1) AS max_year,
               (SELECT min(v) FROM e) AS min_value,
               (SELECT year FROM e ORDER BY v, year LIMIT 1) AS min_year""",
    "top10_entities": PANEL + """
        SELECT entity_id, entity_name, sector, round(m, 6) AS mean_enrolled, round(r, 6) AS mean_grad_rate,
               substring(entity_name, 1, 40) AS short_name
        FROM (SELECT entity_id, entity_name, sector, avg(enrolled) AS m, avg(grad_rate) AS r
              FROM ratios GROUP BY ALL ORDER BY m DESC, entity_id LIMIT 10)""",
    "dept_year_pivot": PANEL + """
        , d AS (SELECT department, year, avg(grad_rate * 100) AS rate FROM ratios GROUP BY ALL)
        , t AS (SELECT department, count(entity_id) AS n_rows FROM ratios GROUP BY ALL
                ORDER BY n_rows DESC, department LIMIT 20)
        SELECT department, n_rows,
        """ + ", ".join(f"round(max(rate) FILTER (year = {y}), 6) AS y{y}" for y in range(1995, 2002)) + """,
               round(avg(rate), 6) AS row_mean
        FROM d JOIN t USING (department) GROUP BY ALL""",
    "top_department_rows": PANEL + """
        SELECT entity_id, department, year, enrolled FROM metrics WHERE department IN (
          SELECT department FROM metrics GROUP BY department ORDER BY count(*) DESC, department LIMIT 5)""",
    "load_efficiency_fit": PROFILE + """
        SELECT n, round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(r, 6) AS r,
               round(x_min, 6) AS x_min, round(x_max, 6) AS x_max FROM fit""",
    "load_trend_line": PROFILE + """
        SELECT CAST(i AS INTEGER) AS point, round(x_min + (x_max - x_min) * i / 99, 4) AS x,
               round(slope * (x_min + (x_max - x_min) * i / 99) + intercept, 4) AS y
        FROM fit, range(100) t(i)""",
    "marker_clip": PROFILE + """
        SELECT entity_id, round(greatest(least(mean_enrolled / (SELECT max(mean_enrolled) FROM profile) * 500,
               500.0), 20.0), 6) AS mark FROM profile""",
    "sector_trend": PANEL + """
        SELECT sector, year, sum(enrolled) AS enrolled, sum(graduated) AS graduated,
               sum(applicants) AS applicants, round(avg(grad_rate), 6) AS mean_rate
        FROM ratios GROUP BY sector, year""",
    "funnel_by_year": PANEL + """
        , y AS (SELECT year, sum(applicants) a, sum(admitted) b, sum(enrolled) c, sum(graduated) d
                FROM metrics WHERE year IN (1995, 1998, 2001) GROUP BY year)
        , s AS (SELECT year, 1 stage_no, 'applicants' stage, a AS value, a, greatest(a, b, c, d) m FROM y
                UNION ALL SELECT year, 2, 'admitted', b, a, greatest(a, b, c, d) FROM y
                UNION ALL SELECT year, 3, 'enrolled', c, a, greatest(a, b, c, d) FROM y
                UNION ALL SELECT year, 4, 'graduated', d, a, greatest(a, b, c, d) FROM y)
        SELECT year, stage_no, stage, value,
               CASE WHEN a > 0 THEN value * 100 / a ELSE 0.0 END AS pct_of_first,
               CASE WHEN m > 0 THEN value / m END AS width FROM s""",
    "unsustainable_growth": PANEL + """
        , e AS (SELECT entity_id, entity_name, sector, department, avg(staff_load) AS mean_load,
                       avg(grad_rate) AS mean_rate, avg(growth) AS mean_growth, avg(enrolled) AS mean_enrolled
                FROM lagged WHERE year >= 1999 GROUP BY ALL
                HAVING avg(staff_load) IS NOT NULL AND avg(grad_rate) IS NOT NULL)
        SELECT entity_id, entity_name, sector, department, round(mean_load, 6) AS mean_load,
               round(mean_rate, 6) AS mean_rate, round(mean_growth, 6) AS mean_growth,
               round(mean_enrolled, 6) AS mean_enrolled
        FROM e WHERE mean_load > (SELECT quantile_cont(mean_load, 0.75) FROM e)
          AND mean_rate < (SELECT quantile_cont(mean_rate, 0.25) FROM e)""",
    "regional_change": CHANGE + """
        SELECT *, CASE WHEN change_pp < 0 THEN 'down' ELSE 'up' END AS trend FROM changed""",
    "regional_deterioration": CHANGE + """
        SELECT department, round(rate_before * 100, 2) AS rate_before_pct,
               round(rate_after * 100, 2) AS rate_after_pct, round(change_pp, 2) + 0.0 AS change_pp
        FROM changed WHERE change_pp < 0""",
    "regional_bands": CHANGE + """
        SELECT department, rate_after,
               CASE WHEN rate_after < (SELECT quantile_cont(rate_after, 0.3) FROM changed) THEN 'critical'
                    WHEN rate_after < (SELECT quantile_cont(rate_after, 0.6) FROM changed) THEN 'medium'
                    ELSE 'high' END AS band FROM changed""",
    "yearly_correlation": PANEL + """
        SELECT year, CASE WHEN stddev_pop(staff_load) * stddev_pop(grad_rate) <> 0
                          THEN round(covar_pop(staff_load, grad_rate)
                                     / (stddev_pop(staff_load) * stddev_pop(grad_rate)), 6) END AS correlation,
               (SELECT round(corr(staff_load, grad_rate), 6) FROM ratios
                WHERE staff_load < 1500 AND grad_rate < 2) AS overall
        FROM ratios WHERE staff_load IS NOT NULL AND grad_rate IS NOT NULL GROUP BY year""",
    "density_grid": PANEL + """
        , p AS (SELECT staff_load AS x, grad_rate * 100 AS y FROM ratios
                WHERE staff_load < 1500 AND grad_rate < 2 AND enrolled IS NOT NULL)
        , s AS (SELECT min(x) x0, (max(x) - min(x)) / 25 wx, min(y) y0, (max(y) - min(y)) / 25 wy FROM p)
        SELECT CAST(least(CASE WHEN wx > 0 THEN floor((x - x0) / wx) ELSE 0 END, 24) AS INTEGER) AS bin_x,
               CAST(least(CASE WHEN wy > 0 THEN floor((y - y0) / wy) ELSE 0 END, 24) AS INTEGER) AS bin_y,
               count(*) AS n
        FROM p, s GROUP BY 1, 2""",
    "hex_density": PANEL + """
        , p AS (SELECT staff_load AS x, grad_rate * 100 AS y FROM ratios
                WHERE staff_load < 1500 AND grad_rate < 2 AND enrolled IS NOT NULL)
        , s AS (SELECT min(x) x0, max(x) - min(x) wx, min(y) y0, max(y) - min(y) wy FROM p)
        , u AS (SELECT CASE WHEN wx > 0 THEN (x - x0) / wx * 25 ELSE 0 END AS u, CASE WHEN wy > 0 THEN (y - y0) / wy * 14 ELSE 0 END AS r FROM p, s)
        , c AS (SELECT u - r / 2 AS q, r, -(u - r / 2) - r AS t FROM u)
        , n AS (SELECT *, floor(q + 0.5) AS qn, floor(r + 0.5) AS rn, floor(t + 0.5) AS tn FROM c)
        , h AS (SELECT CASE WHEN abs(qn - q) > abs(rn - r) AND abs(qn - q) > abs(tn - t) THEN -rn - tn ELSE qn END AS q,
                       CASE WHEN NOT (abs(qn - q) > abs(rn - r) AND abs(qn - q) > abs(tn - t)) AND abs(rn - r) > abs(tn - t)
                            THEN -qn - tn ELSE rn END AS r FROM n)
        SELECT CAST(q AS INTEGER) AS q, CAST(r AS INTEGER) AS r, count(*) AS n FROM h GROUP BY ALL""",
    "area_loss": PANEL + """
        , l AS (SELECT p_type AS area, yr, l_quantity q, l_linestatus = 'F' e, l_linestatus = 'F' AND l_returnflag = 'A' g
                FROM li JOIN part ON l_partkey = p_partkey)
        , m AS (SELECT area, yr, sum(q) v FROM l WHERE e GROUP BY ALL)
        , i AS (SELECT area, yr, sum(q) v FROM l GROUP BY ALL)
        , g AS (SELECT area, yr, sum(q) v FROM l WHERE g GROUP BY ALL)
        , y AS (SELECT area, m.v AS ma, coalesce(i.v, 0.0) AS ia, coalesce(g.v, 0.0) AS ga
                FROM m LEFT JOIN i USING (area, yr) LEFT JOIN g USING (area, yr))
        , a AS (SELECT area, avg(ia) AS mi, avg(ma) AS mm, avg(ga) AS mg FROM y GROUP BY area)
        , r AS (SELECT *, mm / mi AS permanence, mg / mm AS graduation, (1 - mg / mi) * 100 AS loss_pct
                FROM a WHERE mi > 0 AND mm > 0 ORDER BY loss_pct DESC, area LIMIT 15)
        SELECT area, round(mi, 6) AS mean_applicants, round(mm, 6) AS mean_enrolled, round(mg, 6) AS mean_graduated,
               round(permanence, 6) AS permanence, round(graduation, 6) AS graduation, round(loss_pct, 6) AS loss_pct,
               substring(area, 1, 35) AS short_area,
               CASE WHEN loss_pct > 85 THEN 'critical' WHEN loss_pct > 70 THEN 'high' ELSE 'moderate' END AS band
        FROM r""",
    "exec_summary": PANEL + """
        SELECT count(*) AS n_rows, count(DISTINCT entity_id) AS n_entities, count(DISTINCT year) AS n_years,
               min(year) AS first_year_seen, max(year) AS last_year_seen,
               count(*) FILTER (at_risk = 1) AS n_at_risk,
               round(count(*) FILTER (at_risk = 1) * 100 / count(*), 1) AS pct_at_risk
        FROM labelled""",
}
