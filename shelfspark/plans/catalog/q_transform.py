"""Projections, filters, key joins, sorts, set operations and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.functions import scalar as S
from shelfspark.operators import transform as X
from shelfspark.operators.features import group_mode, quantile_bin_expr
from shelfspark.plans.catalog.base import CUT, register, sales_view, table, with_sales
from shelfspark.plans.retail import TESTDATA_PRESET as P

_SALES_COLS = ("l_orderkey, l_linenumber, Item_Identifier, Item_Weight, Item_Fat_Content, Item_Visibility, Item_Type, "
               "Item_MRP, Outlet_Identifier, Outlet_Establishment_Year, Outlet_Size, Outlet_Location_Type, "
               "Outlet_Type, Item_Outlet_Sales, date_created")
_DROPPED = ("Item_Identifier", "Outlet_Identifier", "Item_Type", "Item_Fat_Content")


def _sql_case(col: str, mapping: dict, quote=True) -> str:
    q = (lambda v: "'" + str(v).replace("'", "''") + "'") if quote else str
    arms = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {col} {arms} ELSE {col} END"


# ---- 2.2 projections and filters ---------------------------------------------

@register("drop_columns", with_sales("SELECT " + ", ".join(
    c.strip() for c in _SALES_COLS.split(",") if c.strip() not in _DROPPED) + " FROM sales"))
def q_drop_columns(spark, d):
    return X.drop_columns(sales_view(spark, d), _DROPPED)


@register("constant_column", "SELECT 'train' AS \"Set\", * FROM orders")
def q_constant_column(spark, d):
    return X.constant_column(table(spark, d, "orders"), "Set", "train")


@register("add_row_id", """
SELECT md5(CAST(o_orderkey AS VARCHAR) || '|' || CAST(o_custkey AS VARCHAR)) AS item_id,
       o_orderkey, o_custkey, o_totalprice
FROM orders""")
def q_add_row_id(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return X.add_row_id(o, "item_id", ["o_orderkey", "o_custkey"], method="md5")


@register("reorder_columns", "SELECT p_type, p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def q_reorder_columns(spark, d):
    return X.reorder_first(table(spark, d, "part"), ["p_type"])


@register("rename_columns",
          "SELECT n_nationkey AS nation_id, n_name AS nation_name, n_regionkey AS region_id FROM nation")
def q_rename_columns(spark, d):
    return X.rename_columns(table(spark, d, "nation"),
                            {"n_nationkey": "nation_id", "n_name": "nation_name", "n_regionkey": "region_id"})


@register("age_from_year",
          "SELECT o_orderkey, CAST(2020 - year(o_orderdate) AS INTEGER) AS outlet_age FROM orders")
def q_age_from_year(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", S.age_from_year(F.year("o_orderdate"), 2020).alias("outlet_age"))


@register("recode", "SELECT p_partkey, " + _sql_case("p_type", P.type_recode) + " AS p_type FROM part")
def q_recode(spark, d):
    return X.recode_column(table(spark, d, "part").select("p_partkey", "p_type"), "p_type", P.type_recode)


@register("conditional_set", with_sales(
    "SELECT l_orderkey, l_linenumber, Outlet_Identifier, CASE WHEN Outlet_Identifier IN ("
    + ", ".join(str(x) for x in P.small_outlets) + f") THEN '{P.small_label}' ELSE Outlet_Size END AS Outlet_Size "
    "FROM sales"))
def q_conditional_set(spark, d):
    s = sales_view(spark, d, ["l_orderkey", "l_linenumber", "Outlet_Identifier", "Outlet_Size"])
    return X.conditional_set(s, "Outlet_Size", "Outlet_Identifier", P.small_outlets, P.small_label)


@register("filter_eq", with_sales(
    "SELECT l_orderkey, l_linenumber, Item_Fat_Content, Item_Outlet_Sales FROM sales WHERE Item_Fat_Content = 'R'"))
def q_filter_eq(spark, d):
    s = sales_view(spark, d, ["l_orderkey", "l_linenumber", "Item_Fat_Content", "Item_Outlet_Sales"])
    return X.filter_eq(s, "Item_Fat_Content", "R")


@register("filter_null", with_sales(
    "SELECT l_orderkey, l_linenumber, Item_Identifier, Item_Weight FROM sales WHERE Item_Weight IS NULL"))
def q_filter_null(spark, d):
    s = sales_view(spark, d, ["l_orderkey", "l_linenumber", "Item_Identifier", "Item_Weight"])
    return X.filter_null(s, "Item_Weight")


@register("drop_missing", with_sales(
    "SELECT l_orderkey, l_linenumber, Item_Identifier, Item_Weight, Outlet_Size FROM sales "
    "WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL AND Item_Identifier IS NOT NULL "
    "AND Item_Weight IS NOT NULL AND Outlet_Size IS NOT NULL"))
def q_drop_missing(spark, d):
    s = sales_view(spark, d, ["l_orderkey", "l_linenumber", "Item_Identifier", "Item_Weight", "Outlet_Size"])
    return X.drop_missing(s)


@register("split_by_date", with_sales(
    f"SELECT 'reference' AS part, l_orderkey, l_linenumber, date_created FROM sales WHERE date_created <= DATE '{CUT}' "
    f"UNION ALL SELECT 'current' AS part, l_orderkey, l_linenumber, date_created FROM sales WHERE date_created > DATE '{CUT}'"))
def q_split_by_date(spark, d):
    s = sales_view(spark, d, ["l_orderkey", "l_linenumber", "date_created"])
    ref, cur = X.split_by_date(s, "date_created", CUT)
    return X.constant_column(ref, "part", "reference").unionByName(X.constant_column(cur, "part", "current"))


@register("split_by_tag", """
SELECT 'train' AS side, l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_linestatus = 'F'
UNION ALL SELECT 'test' AS side, l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_linestatus = 'O'""")
def q_split_by_tag(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_linestatus")
    tr, te = X.split_by_tag(li, "l_linestatus", "F", "O")
    return X.constant_column(tr, "side", "train").unionByName(X.constant_column(te, "side", "test"))


@register("cast_columns", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, TRY_CAST(event_type AS DOUBLE) AS event_type
FROM events""")
def q_cast_columns(spark, d):
    e = table(spark, d, "events").select("event_id", S.json_field("props", "$.k").alias("k"), "event_type")
    return X.cast_columns(e, {"k": "double", "event_type": "double"})


# ---- 2.3 joins ---------------------------------------------------------------

@register("lookup_join", with_sales("""
, counts AS (SELECT Item_Identifier, Item_Weight, count(*) AS n FROM sales WHERE Item_Weight IS NOT NULL GROUP BY 1, 2)
, modes AS (SELECT Item_Identifier, Item_Weight AS brand_mode FROM (
    SELECT *, row_number() OVER (PARTITION BY Item_Identifier ORDER BY n DESC, Item_Weight) AS rn FROM counts) WHERE rn = 1)
SELECT s.l_orderkey, s.l_linenumber, s.Item_Identifier, COALESCE(m.brand_mode, -1.0) AS brand_mode
FROM sales s LEFT JOIN modes m ON s.Item_Identifier = m.Item_Identifier"""))
def q_lookup_join(spark, d):
    s = sales_view(spark, d, ["l_orderkey", "l_linenumber", "Item_Identifier", "Item_Weight"])
    modes = group_mode(s, "Item_Identifier", "Item_Weight", out="brand_mode")
    base = s.select("l_orderkey", "l_linenumber", "Item_Identifier")
    return X.lookup_join(base, modes, "Item_Identifier", "brand_mode", default=-1.0)


@register("semi_filter", """
SELECT o_orderkey, o_totalprice FROM orders o
WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')""")
def q_semi_filter(spark, d):
    li = table(spark, d, "lineitem").filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return X.semi_filter(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), li, "o_orderkey")


@register("anti_filter", """
SELECT o_orderkey, o_totalprice FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')""")
def q_anti_filter(spark, d):
    li = table(spark, d, "lineitem").filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return X.anti_filter(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), li, "o_orderkey")


@register("isin_filter", "SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey IN ("
          + ", ".join(str(x) for x in P.small_outlets) + ")")
def q_isin_filter(spark, d):
    return X.isin_filter(table(spark, d, "supplier").select("s_suppkey", "s_name"), "s_suppkey", P.small_outlets)


@register("column_concat", """
SELECT COALESCE(o.o_orderkey, t.o_orderkey) AS o_orderkey, o.o_totalprice, o.o_orderpriority, t.revenue
FROM orders o FULL JOIN (SELECT l_orderkey AS o_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
                    FROM lineitem GROUP BY 1) t ON o.o_orderkey = t.o_orderkey""")
def q_column_concat(spark, d):
    feats = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    target = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("revenue"))
    return X.column_concat(feats, target, "o_orderkey")


_CUTS = [900.0, 925.0, 950.0, 975.0, 1000.0]


@register("bin_lookup", "SELECT p_partkey, p_retailprice, CASE WHEN p_retailprice IS NULL THEN NULL "
          "WHEN p_retailprice <= 925.0 THEN 1 WHEN p_retailprice <= 950.0 THEN 2 WHEN p_retailprice <= 975.0 THEN 3 "
          "ELSE 4 END AS price_bin FROM part")
def q_bin_lookup(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_retailprice")
    return p.withColumn("price_bin", quantile_bin_expr("p_retailprice", _CUTS))


# ---- 2.5 windows, sorts, limits, sets -----------------------------------------

@register("group_transform", with_sales("""
, g AS (SELECT Item_Identifier, avg(Item_Outlet_Sales) AS m FROM sales GROUP BY 1)
SELECT s.l_orderkey, s.l_linenumber, s.Item_Identifier, round(g.m, 4) AS brand_mean_sales
FROM sales s LEFT JOIN g ON s.Item_Identifier = g.Item_Identifier"""))
def q_group_transform(spark, d):
    s = sales_view(spark, d, ["l_orderkey", "l_linenumber", "Item_Identifier", "Item_Outlet_Sales"])
    g = s.groupBy("Item_Identifier").agg(F.avg("Item_Outlet_Sales").alias("m"))
    return X.lookup_join(s.select("l_orderkey", "l_linenumber", "Item_Identifier"), g, "Item_Identifier", "m") \
        .select("l_orderkey", "l_linenumber", "Item_Identifier", F.round("m", 4).alias("brand_mean_sales"))


@register("sort_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10")
def q_sort_limit(spark, d):
    return X.sort_limit(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 10)


@register("sort_limit_last",
          "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 10")
def q_sort_limit_last(spark, d):
    return X.sort_limit(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"],
                        10, last=True)


@register("union_rows", with_sales(
    f"SELECT 'train' AS \"Set\", l_orderkey, l_linenumber, Item_MRP, Item_Outlet_Sales FROM sales "
    f"WHERE date_created <= DATE '{CUT}' UNION ALL "
    f"SELECT 'test' AS \"Set\", l_orderkey, l_linenumber, Item_MRP, NULL AS Item_Outlet_Sales FROM sales "
    f"WHERE date_created > DATE '{CUT}'"))
def q_union_rows(spark, d):
    s = sales_view(spark, d, ["l_orderkey", "l_linenumber", "Item_MRP", "Item_Outlet_Sales", "date_created"])
    tr, te = X.split_by_date(s, "date_created", CUT)
    tr = X.constant_column(tr.drop("date_created"), "Set", "train")
    te = X.constant_column(te.drop("date_created", "Item_Outlet_Sales"), "Set", "test")
    return X.union_rows(tr, te)


@register("dedupe_sorted", "SELECT DISTINCT p_type FROM part ORDER BY p_type")
def q_dedupe_sorted(spark, d):
    return X.dedupe_sorted(table(spark, d, "part"), "p_type")


# ---- 2.6 scalar functions ----------------------------------------------------

@register("str_replace", "SELECT o_orderkey, replace(replace(o_orderpriority, ' ', '_'), '-', '_') AS priority_name FROM orders")
def q_str_replace(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", S.dash_to_underscore(S.underscore_blanks("o_orderpriority")).alias("priority_name"))


@register("str_trim", "SELECT doc_id, regexp_replace(text, '[\\r\\n]+$', '') AS text FROM documents")
def q_str_trim(spark, d):
    return table(spark, d, "documents").select("doc_id", S.strip_line_end("text").alias("text"))


@register("str_prefix", "SELECT p_partkey, substr(p_type, 1, 2) AS family FROM part")
def q_str_prefix(spark, d):
    return table(spark, d, "part").select("p_partkey", S.prefix("p_type", 2).alias("family"))


@register("date_format_iso", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date_feat FROM orders")
def q_date_format_iso(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.iso_date("o_orderdate").alias("date_feat"))


@register("arithmetic", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 6) AS revenue,
       round(sqrt(l_quantity), 6) AS sqrt_qty, round(100.0 * l_discount, 6) AS discount_pct
FROM lineitem""")
def q_arithmetic(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 6).alias("revenue"),
                     F.round(F.sqrt("l_quantity"), 6).alias("sqrt_qty"),
                     F.round(F.lit(100.0) * F.col("l_discount"), 6).alias("discount_pct"))


@register("json_fields", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def q_json_fields(spark, d):
    return table(spark, d, "events").select("event_id", S.json_field("props", "$.k").cast("int").alias("k"))
