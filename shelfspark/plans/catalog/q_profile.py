"""Profiling and grouped statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.operators import profile as PR
from shelfspark.operators.features import global_mode_frame, group_mode
from shelfspark.plans.catalog.base import register, sales_view, table, with_sales

_SALES_COLS = ["l_orderkey", "l_linenumber", "Item_Identifier", "Item_Weight", "Item_Fat_Content", "Item_Visibility",
               "Item_Type", "Item_MRP", "Outlet_Identifier", "Outlet_Establishment_Year", "Outlet_Size",
               "Outlet_Location_Type", "Outlet_Type", "Item_Outlet_Sales", "date_created"]
_LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("group_mode", """
SELECT p_brand, p_size AS mode FROM (
  SELECT p_brand, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_size) AS rn
  FROM part GROUP BY p_brand, p_size) WHERE rn = 1""")
def q_group_mode(spark, d):
    return group_mode(table(spark, d, "part"), "p_brand", "p_size")


@register("global_mode", """
SELECT l_quantity AS mode FROM (SELECT l_quantity, count(*) AS n FROM lineitem GROUP BY 1)
ORDER BY n DESC, l_quantity LIMIT 1""")
def q_global_mode(spark, d):
    return global_mode_frame(table(spark, d, "lineitem"), "l_quantity")


@register("distinct_values", "SELECT DISTINCT c_mktsegment FROM customer")
def q_distinct_values(spark, d):
    return PR.distinct_values(table(spark, d, "customer"), "c_mktsegment")


@register("count_distinct", """
SELECT count(DISTINCT l_partkey) AS l_partkey, count(DISTINCT l_suppkey) AS l_suppkey,
       count(DISTINCT l_returnflag) AS l_returnflag, count(DISTINCT l_quantity) AS l_quantity FROM lineitem""")
def q_count_distinct(spark, d):
    return PR.count_distinct(table(spark, d, "lineitem"), ["l_partkey", "l_suppkey", "l_returnflag", "l_quantity"])


@register("value_counts", """
SELECT l_returnflag, count(*) AS n, count(*) / (SELECT count(*) FROM lineitem) AS share
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY 1""")
def q_value_counts(spark, d):
    return PR.value_counts(table(spark, d, "lineitem"), "l_returnflag")


@register("null_profile", with_sales(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, "
    f"(count(*) - count({c})) * 100.0 / count(*) AS pct FROM sales" for c in _SALES_COLS)))
def q_null_profile(spark, d):
    return PR.null_profile(sales_view(spark, d))


_ORDERS_TYPES = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                 ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]


@register("schema_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null, count(*) AS \"rows\", "
    f"{len(_ORDERS_TYPES)} AS n_columns FROM orders" for c, t in _ORDERS_TYPES))
def q_schema_profile(spark, d):
    return PR.schema_profile(table(spark, d, "orders"))


@register("describe_numeric", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
    f"min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, "
    f"round(quantile_cont({c}, 0.75), 6) AS p75, max({c}) AS max FROM lineitem" for c in _LI_NUM))
def q_describe_numeric(spark, d):
    r = PR.describe_numeric(table(spark, d, "lineitem"), _LI_NUM)
    return r.select("column", "count", *[F.round(c, 6).alias(c) for c in ("mean", "std")], "min",
                    *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75")], "max")


@register("describe_categorical", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
       arg_min({c}, struct_pack(a := -n, b := {c})) AS top, max(n) AS freq
FROM (SELECT {c}, count(*) AS n FROM orders WHERE {c} IS NOT NULL GROUP BY 1)""" for c in ["o_orderstatus", "o_orderpriority"]))
def q_describe_categorical(spark, d):
    return PR.describe_categorical(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


@register("crosstab", with_sales("SELECT Outlet_Type, " + ", ".join(
    f"count(*) FILTER (WHERE Outlet_Size = '{p}') AS \"{p}\"" for p in _PRIORITIES) + " FROM sales GROUP BY 1"))
def q_crosstab(spark, d):
    return PR.crosstab(sales_view(spark, d, ["Outlet_Type", "Outlet_Size"]), "Outlet_Type", "Outlet_Size", _PRIORITIES)


@register("grouped_counts", with_sales(
    "SELECT Item_Type, Item_Fat_Content, count(*) AS n FROM sales GROUP BY 1, 2"))
def q_grouped_counts(spark, d):
    return PR.grouped_counts(sales_view(spark, d, ["Item_Type", "Item_Fat_Content"]), "Item_Type", "Item_Fat_Content")


@register("grouped_mean", with_sales("""
SELECT Item_Type, n, round(mean, 4) AS mean, round(std, 4) AS std,
       round(mean - 1.959963984540054 * std / sqrt(n), 4) AS ci_low, round(mean + 1.959963984540054 * std / sqrt(n), 4) AS ci_high
FROM (SELECT Item_Type, count(Item_Outlet_Sales) AS n, avg(Item_Outlet_Sales) AS mean, stddev_samp(Item_Outlet_Sales) AS std
      FROM sales GROUP BY 1)"""))
def q_grouped_mean(spark, d):
    r = PR.grouped_mean(sales_view(spark, d, ["Item_Type", "Item_Outlet_Sales"]), "Item_Type", "Item_Outlet_Sales")
    return r.select("Item_Type", "n", *[F.round(c, 4).alias(c) for c in ("mean", "std", "ci_low", "ci_high")])


_BOOT_B = 40
_BOOT_WEIGHT = "CASE " + " ".join(f"WHEN word < '{w}' THEN {k}" for k, w in enumerate(PR.POISSON_STEPS)) + f" ELSE {len(PR.POISSON_STEPS)} END"


@register("grouped_mean_bootstrap", f"""
WITH li AS (SELECT l_returnflag AS g, l_extendedprice AS v, CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) || '|' ||
                   CAST(l_partkey AS VARCHAR) || '|' || CAST(l_suppkey AS VARCHAR) AS k FROM lineitem),
w AS (SELECT g, v, c * 8 + j AS b, substr(h, 4 * j + 1, 4) AS word
      FROM (SELECT g, v, c, md5(k || '|28|' || c) AS h FROM li, range(0, {_BOOT_B // 8}) t(c)), range(0, 8) u(j)),
m AS (SELECT g, b, sum({_BOOT_WEIGHT} * v) / sum({_BOOT_WEIGHT}) AS m FROM w GROUP BY g, b)
SELECT m.g AS l_returnflag, any_value(n) AS n, round(any_value(mean), 4) AS mean, round(quantile_cont(m, 0.025), 4) AS ci_low, round(quantile_cont(m, 0.975), 4) AS ci_high
FROM m JOIN (SELECT g, count(v) AS n, avg(v) AS mean FROM li GROUP BY g) a ON m.g = a.g GROUP BY m.g""")
def q_grouped_mean_bootstrap(spark, d):
    """Bootstrap interval of the mean price per return flag."""
    r = PR.grouped_mean_bootstrap(table(spark, d, "lineitem"), "l_returnflag", "l_extendedprice",
                                  ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], replicates=_BOOT_B)
    return r.select("l_returnflag", "n", *[F.round(c, 4).alias(c) for c in ("mean", "ci_low", "ci_high")])


@register("box_stats", with_sales("""
, named AS (SELECT NULLIF(Outlet_Type, 'BUILDING') AS Outlet_Type, Item_Outlet_Sales FROM sales)
, q AS (SELECT Outlet_Type, quantile_cont(Item_Outlet_Sales, 0.25) AS q1, quantile_cont(Item_Outlet_Sales, 0.5) AS median,
               quantile_cont(Item_Outlet_Sales, 0.75) AS q3 FROM named WHERE Item_Outlet_Sales IS NOT NULL GROUP BY 1)
SELECT q.Outlet_Type, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, round(q3 - q1, 4) AS iqr,
       round(min(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END), 4) AS whisker_low,
       round(max(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END), 4) AS whisker_high,
       CAST(sum(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN 0 ELSE 1 END) AS BIGINT) AS outliers
FROM q JOIN (SELECT Outlet_Type, Item_Outlet_Sales AS v FROM named WHERE Item_Outlet_Sales IS NOT NULL) s
  ON q.Outlet_Type IS NOT DISTINCT FROM s.Outlet_Type
GROUP BY q.Outlet_Type, q1, median, q3"""))
def q_box_stats(spark, d):
    s = sales_view(spark, d, ["Outlet_Type", "Item_Outlet_Sales"]).withColumn("Outlet_Type", F.expr("nullif(Outlet_Type, 'BUILDING')"))
    r = PR.box_stats(s, "Outlet_Type", "Item_Outlet_Sales")
    return r.select("Outlet_Type", *[F.round(c, 4).alias(c) for c in
                                     ("q1", "median", "q3", "iqr", "whisker_low", "whisker_high")], "outliers")


@register("histogram", """
WITH mm AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT LEAST(CAST(floor((l_extendedprice - lo) / ((hi - lo) / 30)) AS INTEGER), 29) AS bin, lo, hi
      FROM lineitem, mm WHERE l_extendedprice IS NOT NULL)
SELECT g.bin, round(lo + g.bin * ((hi - lo) / 30), 4) AS lower, round(lo + (g.bin + 1) * ((hi - lo) / 30), 4) AS upper,
       COALESCE(c.n, 0) AS n
FROM (SELECT CAST(i AS INTEGER) AS bin FROM range(0, 30) t(i)) g CROSS JOIN mm
LEFT JOIN (SELECT bin, count(*) AS n FROM b GROUP BY bin) c ON c.bin = g.bin""")
def q_histogram(spark, d):
    r = PR.histogram(table(spark, d, "lineitem"), "l_extendedprice", 30)
    return r.select("bin", F.round("lower", 4).alias("lower"), F.round("upper", 4).alias("upper"), "n")


_KDE_ERROR = 1e-4


@register("density_grid", f"""
WITH st AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, stddev_samp(l_extendedprice) AS sd,
                   count(l_extendedprice) AS n FROM lineitem),
p AS (SELECT lo, n, sd * pow(n, -0.2) AS bw, sd * pow(n, -0.2) * sqrt(4 * {_KDE_ERROR}) AS width, lo - 3 * sd * pow(n, -0.2) AS start,
             (hi - lo + 6 * sd * pow(n, -0.2)) / 99 AS step FROM st),
v AS (SELECT (l_extendedprice - lo) / width AS spot FROM lineitem, p),
nodes AS (SELECT node, sum(mass) AS mass FROM (SELECT floor(spot) AS node, 1 - (spot - floor(spot)) AS mass FROM v
          UNION ALL SELECT floor(spot) + 1, spot - floor(spot) FROM v) GROUP BY node),
g AS (SELECT CAST(i AS INTEGER) AS i FROM range(0, 100) t(i))
SELECT g.i, round(start + g.i * step, 4) AS x,
       round(1e6 * sum(CASE WHEN abs(start + g.i * step - lo - node * width) <= bw * sqrt(-2 * ln({_KDE_ERROR} / 2))
                            THEN mass * exp(-0.5 * pow((start + g.i * step - lo - node * width) / bw, 2)) ELSE 0 END) / (n * bw * sqrt(2 * pi())), 4) AS density
FROM g, nodes, p GROUP BY g.i, start, step, n, bw""")
def q_density_grid(spark, d):
    r = PR.density_grid(table(spark, d, "lineitem"), "l_extendedprice", n_grid=100, error=_KDE_ERROR)
    # density per million units of price, rounded
    return r.select("i", F.round("x", 4).alias("x"), F.round(F.col("density") * 1e6, 4).alias("density"))


_CORR_PAIRS = [(a, b) for i, a in enumerate(_LI_NUM) for b in _LI_NUM[i:]]


@register("corr_matrix", " UNION ALL ".join(
    [f"SELECT '{a}' AS a, '{b}' AS b, " + ("1.0 AS r" if a == b else f"round(corr({a}, {b}), 8) AS r FROM lineitem")
     for a, b in _CORR_PAIRS] +
    [f"SELECT '{b}' AS a, '{a}' AS b, round(corr({a}, {b}), 8) AS r FROM lineitem" for a, b in _CORR_PAIRS if a != b]))
def q_corr_matrix(spark, d):
    r = PR.corr_matrix(table(spark, d, "lineitem"), _LI_NUM)
    return r.select("a", "b", F.round("r", 8).alias("r"))


@register("skewness", """
SELECT round(skewness(l_extendedprice), 8) AS skew_price, round(skewness(l_quantity), 8) AS skew_qty,
       round(skewness(o_totalprice), 8) AS skew_total
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def q_skewness(spark, d):
    j = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.agg(F.round(PR.skewness_corrected("l_extendedprice"), 8).alias("skew_price"),
                 F.round(PR.skewness_corrected("l_quantity"), 8).alias("skew_qty"),
                 F.round(PR.skewness_corrected("o_totalprice"), 8).alias("skew_total"))


@register("row_gate", "SELECT count(*) AS n_rows, count(*) >= 1000 AS passes FROM events")
def q_row_gate(spark, d):
    ok, n = PR.row_gate(table(spark, d, "events"), 1000)
    return spark.createDataFrame([(n, ok)], "n_rows long, passes boolean")


@register("latest_per_key", """
SELECT user_id, event_type, ts, event_id FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def q_latest_per_key(spark, d):
    return PR.latest_per_key(table(spark, d, "events"), ["user_id", "event_type"], "ts", "event_id")


@register("latest_in_stage", """
SELECT user_id, ts, event_id, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC, value DESC) AS rn
    FROM events WHERE event_type = 'click') WHERE rn = 1""")
def q_latest_in_stage(spark, d):
    return PR.latest_per_key(table(spark, d, "events"), ["user_id"], "ts", ["event_id", "value"], "event_type", "click")
