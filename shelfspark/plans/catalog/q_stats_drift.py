"""Rank tests, QQ points, residuals and drift (SURVEY 2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.functions.distributions import norm_ppf
from shelfspark.operators import drift as DR
from shelfspark.operators import stats as ST
from shelfspark.operators.model import simple_model
from shelfspark.operators.ranks import average_ranks
from shelfspark.operators.transform import split_by_date
from shelfspark.plans.catalog.base import CUT, register, sales_view, table, with_sales

_NUM = ["Item_Weight", "Item_Visibility", "Item_MRP", "Item_Outlet_Sales"]
_CAT = ["Item_Fat_Content", "Item_Type", "Outlet_Size", "Outlet_Location_Type", "Outlet_Type"]
_REF = f"date_created <= DATE '{CUT}'"

# ---- 2.5 average rank --------------------------------------------------------


@register("average_rank", """
SELECT v, n, sum(n) OVER (ORDER BY v) - n + (n + 1) / 2.0 AS avg_rank
FROM (SELECT l_extendedprice AS v, count(*) AS n FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY 1)""")
def q_average_rank(spark, d):
    return average_ranks(table(spark, d, "lineitem"), "l_extendedprice")


# ---- 2.8 statistics ----------------------------------------------------------

_RANKS_SQL = """
, vg AS (SELECT {v} AS v, {g} AS g, count(*) AS n_g FROM {src} WHERE {v} IS NOT NULL AND {g} IS NOT NULL {extra} GROUP BY 1, 2)
, vc AS (SELECT v, sum(n_g) AS n FROM vg GROUP BY 1)
, rk AS (SELECT v, n, sum(n) OVER (ORDER BY v) - n + (n + 1) / 2.0 AS r FROM vc)
, grp AS (SELECT g, sum(n_g) AS n, sum(n_g * r) AS rank_sum FROM vg JOIN rk USING (v) GROUP BY g)
, tot AS (SELECT sum(n) AS big_n, sum(n * n * n - n) AS ties FROM rk)
"""


@register("kruskal_wallis", with_sales(_RANKS_SQL.format(v="Item_Outlet_Sales", g="Item_Type", src="sales", extra="") + """
SELECT round((12.0 / (big_n * (big_n + 1)) * (SELECT sum(rank_sum * rank_sum / n) FROM grp) - 3 * (big_n + 1))
             / (1 - ties / (big_n * big_n * big_n - big_n)), 6) AS h,
       CAST((SELECT count(*) FROM grp) - 1 AS INTEGER) AS dof, CAST(big_n AS BIGINT) AS n, CAST((SELECT count(*) FROM grp) AS INTEGER) AS k
FROM tot"""))
def q_kruskal_wallis(spark, d):
    r = ST.kruskal_wallis_frame(sales_view(spark, d, ["Item_Outlet_Sales", "Item_Type"]), "Item_Outlet_Sales", "Item_Type")
    return r.select(F.round("h", 6).alias("h"), "dof", "n", "k")


@register("mann_whitney", "WITH dummy AS (SELECT 1)" + _RANKS_SQL.format(
    v="l_extendedprice", g="l_returnflag", src="lineitem", extra="AND l_returnflag IN ('A', 'R')") + """
SELECT round((SELECT rank_sum FROM grp WHERE g = 'A') - (SELECT n FROM grp WHERE g = 'A') * ((SELECT n FROM grp WHERE g = 'A') + 1) / 2.0, 4) AS u,
       CAST((SELECT n FROM grp WHERE g = 'A') AS BIGINT) AS n1, CAST((SELECT n FROM grp WHERE g = 'R') AS BIGINT) AS n2, CAST(ties AS DOUBLE) AS ties
FROM tot""")
def q_mann_whitney(spark, d):
    r = ST.mann_whitney_frame(table(spark, d, "lineitem"), "l_extendedprice", "l_returnflag", "A", "R")
    return r.select(F.round("u", 4).alias("u"), "n1", "n2", "ties")


@register("wilcoxon_signed", """
WITH dd AS (SELECT l_tax - l_discount AS d FROM lineitem WHERE l_tax - l_discount <> 0)
, vc AS (SELECT abs(d) AS v, count(*) AS n, sum(CASE WHEN d > 0 THEN 1 ELSE 0 END) AS n_pos FROM dd GROUP BY 1)
, rk AS (SELECT v, n, n_pos, sum(n) OVER (ORDER BY v) - n + (n + 1) / 2.0 AS r FROM vc)
SELECT round(sum(n_pos * r), 4) AS w_plus, round(sum((n - n_pos) * r), 4) AS w_minus, CAST(sum(n) AS BIGINT) AS n,
       CAST(sum(n * n * n - n) AS DOUBLE) AS ties FROM rk""")
def q_wilcoxon_signed(spark, d):
    r = ST.wilcoxon_frame(table(spark, d, "lineitem"), "l_tax", "l_discount")
    return r.select(F.round("w_plus", 4).alias("w_plus"), F.round("w_minus", 4).alias("w_minus"), "n",
                    F.col("ties").cast("double").alias("ties"))


@register("wilcoxon_exact", f"""
WITH RECURSIVE pairs AS (SELECT avg(CASE WHEN CAST(o_orderdate AS DATE) <= DATE '{CUT}' THEN o_totalprice END) - avg(CASE WHEN CAST(o_orderdate AS DATE) > DATE '{CUT}' THEN o_totalprice END) AS d
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey)
, vc AS (SELECT abs(d) AS v, count(*) AS n, sum(CASE WHEN d > 0 THEN 1 ELSE 0 END) AS n_pos FROM pairs WHERE d <> 0 GROUP BY 1)
, rk AS (SELECT n, n_pos, sum(n) OVER (ORDER BY v) - n + (n + 1) / 2.0 AS r FROM vc)
, sums AS (SELECT CAST(sum(n) AS BIGINT) AS n, sum(n_pos * r) AS w, CAST(sum(2 * n * r) AS BIGINT) AS top FROM rk)
, each_rank AS (SELECT list(CAST(2 * r AS BIGINT)) AS rs FROM (SELECT r, unnest(range(n)) FROM rk))
, dp(k, p) AS (SELECT 0, list_prepend(1.0::DOUBLE, list_transform(range(top), lambda i: 0.0::DOUBLE)) FROM sums
    UNION ALL SELECT k + 1, list_transform(range(1, len(p) + 1), lambda i: (p[i] + CASE WHEN i > rs[k + 1] THEN p[i - rs[k + 1]] ELSE 0 END) / 2) FROM dp, each_rank WHERE k < len(rs))
SELECT round(CAST(least(w, n * (n + 1) / 2.0 - w) AS DOUBLE), 4) AS t,
       round(least(1.0, 2 * least(list_sum(p[1:CAST(2 * w AS BIGINT) + 1]), list_sum(p[CAST(2 * w AS BIGINT) + 1:]))), 8) AS p_value, n
FROM dp, sums WHERE k = n""")
def q_wilcoxon_exact(spark, d):
    """Exact test of the nations' mean order prices before and after the cut (one pair per nation)."""
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    old = F.col("o_orderdate").cast("date") <= F.lit(CUT).cast("date")
    pairs = o.groupBy("c_nationkey").agg(F.avg(F.when(old, F.col("o_totalprice"))).alias("old"), F.avg(F.when(~old, F.col("o_totalprice"))).alias("new"))
    r = ST.wilcoxon_signed(pairs, "old", "new", method="exact")
    return spark.createDataFrame([(round(r.statistic, 4), round(r.p_value, 8), r.n)], "t double, p_value double, n long")


_QQ_M = 50
_QQ_P = [(i - 0.5) / _QQ_M for i in range(1, _QQ_M + 1)]


@register("qq_points", " UNION ALL ".join(
    f"SELECT {i} AS i, CAST({p!r} AS DOUBLE) AS p, CAST({round(norm_ppf(p), 8)!r} AS DOUBLE) AS theoretical, "
    f"round(quantile_cont(l_extendedprice, {p!r}), 6) AS sample FROM lineitem"
    for i, p in enumerate(_QQ_P, start=1)))
def q_qq_points(spark, d):
    r = ST.qq_points(table(spark, d, "lineitem"), "l_extendedprice", _QQ_M)
    return r.select("i", "p", F.round("theoretical", 8).alias("theoretical"), F.round("sample", 6).alias("sample"))


@register("residual_table", """
WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
SELECT l_orderkey, l_linenumber, l_extendedprice, round(a + b * l_quantity, 4) AS prediction,
       round((a + b * l_quantity) - l_extendedprice, 4) AS residual
FROM lineitem, m""")
def q_residual_table(spark, d):
    li = table(spark, d, "lineitem")
    model = simple_model(li, "l_quantity", "l_extendedprice")
    r = ST.residual_table(li, "l_extendedprice", model.predict_expr(), keep=["l_orderkey", "l_linenumber"])
    return r.select("l_orderkey", "l_linenumber", "l_extendedprice", F.round("prediction", 4).alias("prediction"),
                    F.round("residual", 4).alias("residual"))


# ---- 2.9 drift -----------------------------------------------------------------

def _ref_cur(spark, d):
    return split_by_date(sales_view(spark, d), "date_created", CUT)


def _counts(spark, d, cols, numeric):
    """Value counts of both periods from one scan of the view, tagged by the date cut."""
    tag = F.col("date_created") <= F.lit(CUT).cast("date")
    return DR.long_counts_tagged(sales_view(spark, d, [*cols, "date_created"]), tag, cols, numeric)


def _long_sql(cols, cast):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS {cast}) AS v, CASE WHEN {_REF} THEN 1 ELSE 0 END AS is_ref FROM sales"
        for c in cols)


_CDF_SQL = """
, u AS ({long})
, c AS (SELECT feature, v, sum(is_ref) AS n_ref, sum(1 - is_ref) AS n_cur FROM u WHERE v IS NOT NULL GROUP BY 1, 2)
, cdf AS (SELECT feature, v, n_ref, n_cur,
                 sum(n_ref) OVER (PARTITION BY feature ORDER BY v) / sum(n_ref) OVER (PARTITION BY feature) AS f_ref,
                 sum(n_cur) OVER (PARTITION BY feature ORDER BY v) / sum(n_cur) OVER (PARTITION BY feature) AS f_cur,
                 lead(v) OVER (PARTITION BY feature ORDER BY v) AS nv
          FROM c)
"""


@register("drift_ks", with_sales(_CDF_SQL.format(long=_long_sql(_NUM, "DOUBLE")) + """
SELECT feature, round(max(abs(f_ref - f_cur)), 8) AS ks_d, CAST(sum(n_ref) AS BIGINT) AS n_ref, CAST(sum(n_cur) AS BIGINT) AS n_cur FROM cdf GROUP BY 1"""))
def q_drift_ks(spark, d):
    r = DR.ks_from_counts(_counts(spark, d, _NUM, True), len(_NUM))
    return r.select("feature", F.round("ks_d", 8).alias("ks_d"), "n_ref", "n_cur")


@register("drift_wasserstein", with_sales(_CDF_SQL.format(long=_long_sql(_NUM, "DOUBLE")) + """
, w AS (SELECT feature, COALESCE(sum(abs(f_ref - f_cur) * (nv - v)), 0.0) AS distance FROM cdf GROUP BY 1)
, s AS (SELECT feature, sqrt(sum(n_ref * pow(v - m, 2)) / sum(n_ref)) AS ref_std
        FROM c JOIN (SELECT feature, sum(v * n_ref) / sum(n_ref) AS m FROM c GROUP BY 1) mm USING (feature) GROUP BY 1)
SELECT feature, round(distance, 6) AS distance, round(ref_std, 6) AS ref_std,
       round(distance / greatest(COALESCE(ref_std, 0.0), 0.001), 8) AS normed
FROM w JOIN s USING (feature)"""))
def q_drift_wasserstein(spark, d):
    r = DR.wasserstein_from_counts(_counts(spark, d, _NUM, True), n_features=len(_NUM))
    return r.select("feature", F.round("distance", 6).alias("distance"), F.round("ref_std", 6).alias("ref_std"),
                    F.round("normed", 8).alias("normed"))


_SHARES_SQL = """
, u AS ({long})
, c AS (SELECT feature, v, sum(is_ref) AS n_ref, sum(1 - is_ref) AS n_cur FROM u WHERE v IS NOT NULL GROUP BY 1, 2)
, t AS (SELECT feature, sum(n_ref) AS t_ref, sum(n_cur) AS t_cur, count(*) AS k FROM c GROUP BY 1)
, sh AS (SELECT c.feature, c.v, n_ref, n_cur, t_ref, t_cur, k,
                CASE WHEN n_ref = 0 THEN 0.0001 ELSE n_ref / t_ref END AS p,
                CASE WHEN n_cur = 0 THEN 0.0001 ELSE n_cur / t_cur END AS q
         FROM c JOIN t USING (feature))
"""


@register("drift_js", with_sales(_SHARES_SQL.format(long=_long_sql(_CAT, "VARCHAR")) + """
, nz AS (SELECT sh.*, p / sum(p) OVER (PARTITION BY feature) AS pn, q / sum(q) OVER (PARTITION BY feature) AS qn FROM sh)
SELECT feature, round(sqrt(greatest(0.0, (sum(pn * ln(pn / ((pn + qn) / 2))) + sum(qn * ln(qn / ((pn + qn) / 2)))) / 2)), 8) AS js
FROM nz GROUP BY 1"""))
def q_drift_js(spark, d):
    return DR.js_from_counts(_counts(spark, d, _CAT, False), n_features=len(_CAT)).select("feature", F.round("js", 8).alias("js"))


@register("drift_chi2", with_sales(_SHARES_SQL.format(long=_long_sql(_CAT, "VARCHAR")) + """
SELECT feature, round(sum(pow(n_cur - p * t_cur, 2) / (p * t_cur)), 6) AS chi2,
       CAST(any_value(k) - 1 AS BIGINT) AS dof
FROM sh GROUP BY 1"""))
def q_drift_chi2(spark, d):
    return DR.chi2_from_counts(_counts(spark, d, _CAT, False), len(_CAT)).select("feature", F.round("chi2", 6).alias("chi2"), F.col("dof").cast("long"))


@register("drift_z", """
WITH u AS (SELECT 'l_linestatus' AS feature, l_linestatus AS v, CASE WHEN l_shipdate <= TIMESTAMP '1999-12-31 00:00:00' THEN 1 ELSE 0 END AS is_ref FROM lineitem)
, c AS (SELECT feature, v, sum(is_ref) AS n_ref, sum(1 - is_ref) AS n_cur FROM u WHERE v IS NOT NULL GROUP BY 1, 2)
, t AS (SELECT feature, sum(n_ref) AS t_ref, sum(n_cur) AS t_cur, min(v) AS label FROM c GROUP BY 1)
SELECT c.feature, round((n_ref / t_ref - n_cur / t_cur) / sqrt(((n_ref + n_cur) / (t_ref + t_cur)) * (1 - (n_ref + n_cur) / (t_ref + t_cur)) * (1.0 / t_ref + 1.0 / t_cur)), 8) AS z
FROM c JOIN t ON c.feature = t.feature AND c.v = t.label""")
def q_drift_z(spark, d):
    li = table(spark, d, "lineitem")
    cut = F.lit("1999-12-31 00:00:00").cast("timestamp_ntz")
    ref, cur = li.filter(F.col("l_shipdate") <= cut), li.filter(F.col("l_shipdate") > cut)
    return DR.z_frame(ref, cur, ["l_linestatus"]).select("feature", F.round("z", 8).alias("z"))


@register("drift_js_numeric", with_sales(f"""
, u AS ({_long_sql(_NUM, "DOUBLE")})
, c AS (SELECT feature, v, sum(is_ref) AS n_ref, sum(1 - is_ref) AS n_cur FROM u WHERE v IS NOT NULL GROUP BY 1, 2)
, rng AS (SELECT feature, min(v) AS lo, max(v) AS hi, CAST(ceil(log2(sum(n_ref) + sum(n_cur)) + 1) AS INTEGER) AS k
          FROM c GROUP BY 1)
, b AS (SELECT c.feature, CASE WHEN hi = lo THEN 0 ELSE LEAST(CAST(floor((v - lo) / ((hi - lo) / k)) AS INTEGER), k - 1) END AS bin,
               sum(n_ref) AS n_ref, sum(n_cur) AS n_cur FROM c JOIN rng USING (feature) GROUP BY 1, 2)
, grid AS (SELECT feature, unnest(range(0, k)) AS bin FROM rng)
, full_ AS (SELECT g.feature, g.bin, COALESCE(b.n_ref, 0) AS n_ref, COALESCE(b.n_cur, 0) AS n_cur
            FROM grid g LEFT JOIN b ON g.feature = b.feature AND g.bin = b.bin)
, sh AS (SELECT feature, bin,
                CASE WHEN n_ref = 0 THEN 0.0001 ELSE n_ref / sum(n_ref) OVER (PARTITION BY feature) END AS p,
                CASE WHEN n_cur = 0 THEN 0.0001 ELSE n_cur / sum(n_cur) OVER (PARTITION BY feature) END AS q FROM full_)
, nz AS (SELECT feature, p / sum(p) OVER (PARTITION BY feature) AS pn, q / sum(q) OVER (PARTITION BY feature) AS qn FROM sh)
SELECT feature, round(sqrt(greatest(0.0, (sum(pn * ln(pn / ((pn + qn) / 2))) + sum(qn * ln(qn / ((pn + qn) / 2)))) / 2)), 8) AS js
FROM nz GROUP BY 1"""))
def q_drift_js_numeric(spark, d):
    return DR.js_numeric_from_counts(_counts(spark, d, _NUM, True), n_features=len(_NUM)).select("feature", F.round("js", 8).alias("js"))


def _tag():
    return F.col("date_created") <= F.lit(CUT).cast("date")


def _report_sql(num, cat):
    """Distance tests of all columns: normed Wasserstein for ``num`` (each has more than five values), Jensen-Shannon for ``cat``."""
    return f"""
, un AS ({_long_sql(num, "DOUBLE")})
, cn AS (SELECT feature, v, sum(is_ref) AS n_ref, sum(1 - is_ref) AS n_cur FROM un WHERE v IS NOT NULL GROUP BY 1, 2)
, cdf AS (SELECT feature, v, sum(n_ref) OVER (PARTITION BY feature ORDER BY v) / sum(n_ref) OVER (PARTITION BY feature) AS f_ref,
                 sum(n_cur) OVER (PARTITION BY feature ORDER BY v) / sum(n_cur) OVER (PARTITION BY feature) AS f_cur,
                 lead(v) OVER (PARTITION BY feature ORDER BY v) AS nv FROM cn)
, w AS (SELECT feature, COALESCE(sum(abs(f_ref - f_cur) * (nv - v)), 0.0) AS distance FROM cdf GROUP BY 1)
, sd AS (SELECT feature, sqrt(sum(n_ref * pow(v - m, 2)) / sum(n_ref)) AS ref_std
         FROM cn JOIN (SELECT feature, sum(v * n_ref) / sum(n_ref) AS m FROM cn GROUP BY 1) mm USING (feature) GROUP BY 1)
, uc AS ({_long_sql(cat, "VARCHAR")})
, cc AS (SELECT feature, v, sum(is_ref) AS n_ref, sum(1 - is_ref) AS n_cur FROM uc WHERE v IS NOT NULL GROUP BY 1, 2)
, sh AS (SELECT feature, CASE WHEN n_ref = 0 THEN 0.0001 ELSE n_ref / sum(n_ref) OVER (PARTITION BY feature) END AS p,
                CASE WHEN n_cur = 0 THEN 0.0001 ELSE n_cur / sum(n_cur) OVER (PARTITION BY feature) END AS q FROM cc)
, nz AS (SELECT feature, p / sum(p) OVER (PARTITION BY feature) AS pn, q / sum(q) OVER (PARTITION BY feature) AS qn FROM sh)
, scores AS (
    SELECT feature, 'num' AS kind, 'wasserstein' AS test, distance / greatest(COALESCE(ref_std, 0.0), 0.001) AS score FROM w JOIN sd USING (feature)
    UNION ALL SELECT feature, 'cat', 'jensenshannon',
        sqrt(greatest(0.0, (sum(pn * ln(pn / ((pn + qn) / 2))) + sum(qn * ln(qn / ((pn + qn) / 2)))) / 2)) FROM nz GROUP BY 1)
"""


_REPORT_SQL = with_sales(_report_sql(_NUM, _CAT) + """
SELECT feature, kind, test, round(score, 8) AS score, CAST(0.1 AS DOUBLE) AS threshold, score >= 0.1 AS drift, 'ok' AS status FROM scores""")


@register("drift_report", _REPORT_SQL)
def q_drift_report(spark, d):
    return DR.drift_report_tagged(sales_view(spark, d), _tag(), _NUM + _CAT).withColumn("score", F.round("score", 8))


@register("drift_report_two_frames", _REPORT_SQL)
def q_drift_report_two_frames(spark, d):
    ref, cur = _ref_cur(spark, d)
    return DR.drift_report(ref, cur, _NUM + _CAT).withColumn("score", F.round("score", 8))


@register("drift_decision", with_sales(_report_sql(_NUM, _CAT) + """
SELECT count(*) AS n_columns, CAST(sum(CASE WHEN score >= 0.1 THEN 1 ELSE 0 END) AS BIGINT) AS n_drifted,
       sum(CASE WHEN score >= 0.1 THEN 1 ELSE 0 END) >= 5 AS drift FROM scores"""))
def q_drift_decision(spark, d):
    return DR.drift_decision(DR.drift_report_tagged(sales_view(spark, d), _tag(), _NUM + _CAT))


_MONITOR_NUM = [*_NUM, "Outlet_Identifier", "Outlet_Establishment_Year"]
_MONITOR_CAT = [*_CAT, "Item_Identifier"]


@register("drift_monitor", with_sales(_report_sql(_MONITOR_NUM, _MONITOR_CAT) + f"""
, gate AS (SELECT count(*) AS n_cur FROM sales WHERE date_created > DATE '{CUT}')
, dec AS (SELECT count(*) AS n_columns, CAST(sum(CASE WHEN score >= 0.1 THEN 1 ELSE 0 END) AS BIGINT) AS n_drifted FROM scores)
SELECT n_cur, n_cur >= 1000 AS gate, CASE WHEN n_cur >= 1000 THEN n_columns ELSE 0 END AS n_columns,
       CASE WHEN n_cur >= 1000 THEN n_drifted ELSE 0 END AS n_drifted, n_cur >= 1000 AND n_drifted >= 5 AS drift FROM gate, dec"""))
def q_drift_monitor(spark, d):
    s = sales_view(spark, d).drop("l_orderkey", "l_linenumber")
    return DR.drift_monitor(s, "date_created", CUT)


@register("qq_points_t")
def q_qq_points_t(spark, d):
    """Price quantiles against those of a Student's t fitted to the prices (no SQL: the fit is iterative)."""
    return ST.qq_points(table(spark, d, "lineitem"), "l_extendedprice", _QQ_M, distribution="t")


@register("kruskal_wallis_test")
def q_kruskal_wallis_test(spark, d):
    """H with its chi-square p-value (p computed on the driver from the aggregate)."""
    r = ST.kruskal_wallis(sales_view(spark, d, ["Item_Outlet_Sales", "Item_Type"]), "Item_Outlet_Sales", "Item_Type")
    return spark.createDataFrame([(r.statistic, r.p_value, r.n)], "h double, p_value double, n long")


@register("mann_whitney_test")
def q_mann_whitney_test(spark, d):
    r = ST.mann_whitney(table(spark, d, "lineitem"), "l_extendedprice", "l_returnflag", "A", "R")
    return spark.createDataFrame([(r.statistic, r.p_value, r.n)], "u double, p_value double, n long")


@register("wilcoxon_test")
def q_wilcoxon_test(spark, d):
    r = ST.wilcoxon_signed(table(spark, d, "lineitem"), "l_tax", "l_discount")
    return spark.createDataFrame([(r.statistic, r.p_value, r.n)], "t double, p_value double, n long")
