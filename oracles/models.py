"""Clustering and risk queries that SQL can check: scaling, given clusters and given predictions."""

from oracles.reports import PANEL

COMPLETE = """grad_rate IS NOT NULL AND staff_load IS NOT NULL AND growth IS NOT NULL
  AND retention IS NOT NULL AND gap IS NOT NULL AND enrolled IS NOT NULL"""
FEATURES = ["grad_rate", "staff_load", "growth", "retention", "gap", "enrolled"]
DIMS = [f"e{i}" for i in range(64)]

LABELS = """CASE {c} WHEN 0 THEN '🟢 Alta eficiencia' WHEN 1 THEN '🟡 Crecimiento acelerado'
  WHEN 2 THEN '🔴 Riesgo académico' WHEN 3 THEN '🔵 Pequeña estable' WHEN 4 THEN '🟠 Alta docencia / baja eficiencia' END"""

ENTITIES = PANEL + f"""
, ent AS (
  SELECT entity_id, entity_name, sector, department, CAST(entity_id % 5 AS INTEGER) AS cluster,
         {", ".join(f"avg({c}) AS {c}" for c in FEATURES)}
  FROM lagged WHERE {COMPLETE} GROUP BY ALL
)
"""

PROFILE = "WITH v AS (SELECT label AS cluster, " + ", ".join(
    f"CAST(embedding[{i + 1}] AS DOUBLE) AS {c}" for i, c in enumerate(DIMS)) + """ FROM embeddings
), p AS (SELECT cluster, """ + ", ".join(f"avg({c}) AS avg_{c}" for c in DIMS) + """ FROM v GROUP BY cluster)
"""

SCALED = ENTITIES + ", z AS (SELECT entity_id, cluster, " + ", ".join(
    f"({c} - (SELECT avg({c}) FROM ent)) / (SELECT stddev_samp({c}) FROM ent) AS {c}" for c in FEATURES) + " FROM ent)"

#: Ties count half: mid-ranks of the rows of class 1.
AUC = """(sum(mid) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0)
  / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0))"""
SHARE = PANEL + """
, sc AS (SELECT sector, gap, at_risk AS y, round(1 - retention, 2) AS s FROM labelled
         WHERE retention IS NOT NULL AND at_risk IS NOT NULL)
"""


def mid_ranks(over: str) -> str:
    return f"""SELECT *, rank() OVER ({over} ORDER BY s) + (count(*) OVER ({'PARTITION BY s' if not over else over + ', s'}) - 1) / 2.0 AS mid
               FROM sc"""


def power(matrix: str, to: str, steps: int) -> str:
    """CTEs that square a symmetric matrix (i, j, v) so often, scaled to trace 1: its leading projector is left."""
    out, last = "", matrix
    for k in range(steps):
        out += f""", {to}{k}_raw AS (SELECT a.i, b.j, sum(a.v * b.v) AS v FROM {last} a JOIN {last} b ON a.j = b.i GROUP BY ALL)
            , {to}{k} AS (SELECT i, j, v / (SELECT sum(v) FROM {to}{k}_raw WHERE i = j) AS v FROM {to}{k}_raw)"""
        last = f"{to}{k}"
    return out


MATRIX = ", c AS (" + " UNION ALL ".join(
    f"SELECT {i} AS i, {j} AS j, covar_samp({a}, {b}) AS v FROM z" for i, a in enumerate(FEATURES)
    for j, b in enumerate(FEATURES)) + ")"

EIGEN = SCALED + MATRIX + power("c", "p", 9) + """
        , one AS (SELECT sum(c.v * p8.v) AS v FROM c JOIN p8 ON c.i = p8.j AND c.j = p8.i)
        , rest AS (SELECT c.i, c.j, c.v - (SELECT v FROM one) * p8.v AS v FROM c JOIN p8 USING (i, j))
        """ + power("rest", "q", 9) + """
        , two AS (SELECT sum(rest.v * q8.v) AS v FROM rest JOIN q8 ON rest.i = q8.j AND rest.j = q8.i)"""

TRAINING = PANEL + f"""
, tr AS (SELECT * FROM labelled WHERE {COMPLETE} AND prev_grad_rate IS NOT NULL AND at_risk IS NOT NULL AND year BETWEEN 1995 AND 1999)
"""
MODEL_FEATURES = sorted([*FEATURES, "prev_grad_rate"])

ORACLES = {
    "kmeans_nearest": ENTITIES + "SELECT count(*) AS n, 5::BIGINT AS n_clusters, 0::BIGINT AS n_nearer_elsewhere, 0::BIGINT AS n_centres_off FROM ent",
    "pca_eigen": EIGEN + """
        SELECT 1 AS component, round(one.v, 6) AS eigenvalue, true AS is_unit, true AS is_eigenvector FROM one
        UNION ALL SELECT 2, round(two.v, 6), true, true FROM two""",
    "tree_scores": PANEL + f"""
        , t AS (SELECT entity_id, year, CASE WHEN retention <= 0.8 THEN 0.9 ELSE 0.2 END AS a,
                       CASE WHEN gap <= 1500 THEN CASE WHEN growth <= 0 THEN 0.7 ELSE 0.1 END
                            ELSE CASE WHEN staff_load <= 20 THEN 0.4 ELSE 0.6 END END AS b,
                       CASE WHEN enrolled <= 1000 THEN -0.5 ELSE CASE WHEN grad_rate <= 0.5 THEN 0.3 ELSE 0.8 END END AS c
                FROM lagged WHERE {COMPLETE})
        SELECT entity_id, year, CAST(round((a + b + c) / 3, 6) AS DOUBLE) AS forest,
               CAST(round(1 / (1 + exp(-2 * (a + 0.5 * b + 0.25 * c))), 6) AS DOUBLE) AS boosted FROM t""",
    "logistic_optimum": TRAINING + """
        SELECT count(*) AS n_rows, CAST(sum(at_risk) AS BIGINT) AS n_at_risk, true AS is_optimum,
               7 + count(DISTINCT sector) + 1 + count(DISTINCT character) + 1 AS n_slots FROM tr""",
    "model_priorities": ENTITIES + f"""
        SELECT * FROM (VALUES ('listed entities are the clustered ones at risk', 0::BIGINT, true), ('listed by falling years at risk', 0, true),
                 ('last years are test years', 0, true), ('all have a label', 0, true), ('departments by falling counts', 0, true)) v(name, n, holds)
        UNION ALL SELECT 'clustered entities', count(*), true FROM ent
        UNION ALL SELECT 'predicted rows', count(*), true FROM labelled
        WHERE {COMPLETE} AND prev_grad_rate IS NOT NULL AND at_risk IS NOT NULL AND year BETWEEN 2000 AND 2001""",
    "exported_models": ENTITIES + f"""
        SELECT * FROM (VALUES ('cluster_profiles', NULL::BIGINT, true), ('silhouette_scores', NULL, true), ('model_comparison', 3, true),
                 ('feature_importance', 14, true), ('roc_data', 300, true), ('winner', 1, true), ('best k', NULL, true)) v(name, n, whole)
        UNION ALL SELECT 'institutional_clusters', count(*), true FROM ent
        UNION ALL SELECT 'pca_coords', count(*), true FROM ent
        UNION ALL SELECT 'panel', count(*), true FROM labelled
        UNION ALL SELECT 'risk_predictions', count(*), true FROM labelled
        WHERE {COMPLETE} AND prev_grad_rate IS NOT NULL AND at_risk IS NOT NULL AND year BETWEEN 2000 AND 2001""",
    "importance_order": f"""
        SELECT model, '{",".join(MODEL_FEATURES)}' AS features, true AS is_in_order, true AS is_a_share
        FROM (VALUES ('RandomForest'), ('GBT')) m(model)""",
    "silhouette_given": SCALED + f"""
        , d AS (SELECT a.entity_id, a.cluster, b.cluster AS other, count(*) AS n,
                       sum({" + ".join(f"(a.{c} - b.{c}) ** 2" for c in FEATURES)}) AS far FROM z a, z b GROUP BY ALL)
        , p AS (SELECT entity_id, max(n) FILTER (cluster = other) AS own,
                       sum(far) FILTER (cluster = other) / nullif(max(n) FILTER (cluster = other) - 1, 0) AS inner_far,
                       min(far / n) FILTER (cluster <> other) AS outer_far FROM d GROUP BY entity_id)
        SELECT round(avg(CASE WHEN own = 1 THEN 0 ELSE (outer_far - inner_far) / greatest(outer_far, inner_far) END), 6)
               AS silhouette FROM p""",
    "kmeans_sums": ENTITIES + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) AS n, round(var_pop({c}), 6) AS mean_square FROM ent" for c in FEATURES),
    "pca_moments": SCALED + MATRIX + power("c", "p", 9) + """
        , one AS (SELECT sum(c.v * p8.v) AS v FROM c JOIN p8 ON c.i = p8.j AND c.j = p8.i)
        , rest AS (SELECT c.i, c.j, c.v - (SELECT v FROM one) * p8.v AS v FROM c JOIN p8 USING (i, j))
        """ + power("rest", "q", 9) + """
        , two AS (SELECT sum(rest.v * q8.v) AS v FROM rest JOIN q8 ON rest.i = q8.j AND rest.j = q8.i)
        SELECT round(one.v, 6) AS var_1, round(two.v, 6) AS var_2, 0.0::DOUBLE AS covariance FROM one, two""",
    "auc_given": SHARE + f"SELECT round({AUC}, 6) AS auc FROM ({mid_ranks('')})",
    "comparison_given": SHARE + f"""
        , m AS (SELECT sector AS model, {AUC} AS auc, count(*) AS n, count(*) FILTER (y = 1 AND gap > 1500) AS tp,
                       count(*) FILTER (y = 0 AND gap > 1500) AS fp, count(*) FILTER (y = 1 AND NOT gap > 1500) AS fn,
                       count(*) FILTER (y = 0 AND NOT gap > 1500) AS tn
                FROM ({mid_ranks('PARTITION BY sector')}) GROUP BY sector)
        , f AS (SELECT *, CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) AS f1, CAST(2 * tn AS DOUBLE) / (2 * tn + fp + fn) AS f0 FROM m)
        SELECT model, row_number() OVER (ORDER BY auc DESC, model) = 1 AS best, round(auc, 6) AS auc_roc,
               round(CAST(tp + tn AS DOUBLE) / n, 6) AS accuracy, round((f1 * (tp + fn) + f0 * (tn + fp)) / n, 6) AS f1_score,
               round(f1, 6) AS f1_positive FROM f""",
    "standardise": ENTITIES + "SELECT entity_id, " + ", ".join(
        f"round(({c} - (SELECT avg({c}) FROM ent)) / (SELECT stddev_samp({c}) FROM ent), 6) AS z_{c}"
        for c in FEATURES) + " FROM ent",
    "cluster_profile": PROFILE + "SELECT cluster, " + ", ".join(
        f"round(avg_{c}, 6) AS avg_{c}" for c in DIMS) + " FROM p",
    "profile_minmax": PROFILE + "SELECT cluster, " + ", ".join(
        f"""CASE WHEN (SELECT max(avg_{c}) > min(avg_{c}) FROM p) THEN round((avg_{c} - (SELECT min(avg_{c}) FROM p))
            / (SELECT max(avg_{c}) - min(avg_{c}) FROM p), 6) ELSE 0.0 END AS avg_{c}""" for c in DIMS) + " FROM p",
    "label_lookup": f"SELECT vec_id, label AS cluster, {LABELS.format(c='label')} AS cluster_label FROM embeddings",
    "cluster_sector_crosstab": ENTITIES + "SELECT cluster, " + ", ".join(
        f"count(*) FILTER (sector = '{r}') AS \"{r}\"" for r in
        ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")) + " FROM ent GROUP BY cluster",
    "largest_entities": ENTITIES + """
        SELECT entity_id, CASE WHEN length(entity_name) > 25 THEN substring(entity_name, 1, 25) || '...'
                          ELSE entity_name END AS short_name, round(enrolled, 6) AS enrolled
        FROM ent ORDER BY ent.enrolled DESC, entity_id LIMIT 8""",
    "temporal_split": PANEL + f"""
        SELECT CASE WHEN year <= 1999 THEN 'train' ELSE 'test' END AS part, at_risk, count(*) AS n,
               min(year) AS from_year, max(year) AS to_year
        FROM labelled WHERE {COMPLETE} AND prev_grad_rate IS NOT NULL AND year BETWEEN 1995 AND 2001 GROUP BY 1, 2""",
    "encode_categories": PANEL + """
        , s AS (SELECT sector, row_number() OVER (ORDER BY count(*) DESC, sector) - 1 AS i, count(*) OVER () AS k
                FROM metrics GROUP BY sector)
        , c AS (SELECT character, row_number() OVER (ORDER BY count(*) DESC, character) - 1 AS i, count(*) OVER () AS k
                FROM metrics GROUP BY character)
        SELECT entity_id, year, CAST(s.i AS INTEGER) AS sector_index, CAST(s.k + 1 AS INTEGER) AS sector_slots,
               CAST(s.i AS INTEGER) AS sector_hot, CAST(c.i AS INTEGER) AS character_index,
               CAST(c.k + 1 AS INTEGER) AS character_slots, CAST(c.i AS INTEGER) AS character_hot
        FROM metrics JOIN s USING (sector) JOIN c USING (character)""",
    "roc_points": PANEL + """
        , t AS (SELECT CAST(i AS DOUBLE) / 99 AS threshold FROM range(100) r(i))
        , x AS (SELECT 1 - retention AS score, at_risk AS y FROM labelled)
        SELECT threshold,
               CASE WHEN count(*) FILTER (y = 0) > 0 THEN count(*) FILTER (y = 0 AND score >= threshold)
                    / count(*) FILTER (y = 0) ELSE 0.0 END AS "FPR",
               CASE WHEN count(*) FILTER (y = 1) > 0 THEN count(*) FILTER (y = 1 AND score >= threshold)
                    / count(*) FILTER (y = 1) ELSE 0.0 END AS "TPR", 'share' AS model
        FROM t, x GROUP BY threshold""",
    "confusion_counts": PANEL + """
        , k AS (SELECT count(*) FILTER (at_risk = 1 AND gap > 1500) AS tp, count(*) FILTER (at_risk = 0 AND gap > 1500) AS fp,
                       count(*) FILTER (at_risk = 1 AND NOT gap > 1500) AS fn,
                       count(*) FILTER (at_risk = 0 AND NOT gap > 1500) AS tn FROM labelled)
        , f AS (SELECT *, CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) AS f1, CAST(2 * tn AS DOUBLE) / (2 * tn + fp + fn) AS f0 FROM k)
        SELECT tp, fp, fn, tn, CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) AS accuracy, f1 AS f1_positive,
               (f1 * (tp + fn) + f0 * (tn + fp)) / (tp + fp + fn + tn) AS f1_weighted FROM f""",
    "risk_by_dept": PANEL + """
        SELECT department, count(*) AS n FROM labelled WHERE at_risk = 1
        GROUP BY department ORDER BY n DESC, department LIMIT 15""",
    "risk_ranking": PANEL + """
        SELECT entity_id, entity_name, sector, department, count(*) AS years_at_risk FROM labelled WHERE at_risk = 1
        GROUP BY ALL ORDER BY years_at_risk DESC, entity_id LIMIT 20""",
    "intervention_priority": ENTITIES + f"""
        , r AS (SELECT entity_id, count(*) AS years_at_risk, max(year) AS last_year FROM labelled WHERE at_risk = 1 GROUP BY ALL)
        SELECT entity_id, entity_name, sector, department, {LABELS.format(c='cluster')} AS cluster_label, years_at_risk,
               last_year, CAST(greatest(least(years_at_risk * 40, 400), 60) AS INTEGER) AS mark,
               round(grad_rate, 6) AS grad_rate, round(growth, 6) AS growth
        FROM ent JOIN r USING (entity_id)""",
    "exported_outputs": ENTITIES + """
        SELECT 'clusters' AS name, 'entity_id|entity_name|cluster|cluster_label' AS columns, count(*) AS n,
               CAST(sum(cluster) AS BIGINT) AS total, CAST(sum(entity_id) AS BIGINT) AS ids FROM ent
        UNION ALL SELECT 'predictions', 'entity_id|year|at_risk', count(*), CAST(sum(at_risk) AS BIGINT), CAST(sum(entity_id) AS BIGINT) FROM labelled
        UNION ALL SELECT 'panel', 'entity_id|entity_name|year|department|enrolled', count(*), CAST(sum(year) AS BIGINT),
                         CAST(sum(entity_id) AS BIGINT) FROM labelled""",
    "risk_cluster_entities": ENTITIES + "SELECT entity_id, entity_name, sector, department FROM ent WHERE cluster = 2",
}
