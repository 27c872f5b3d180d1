"""Feature engineering: modes, bins, encoders, the full fit/apply chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.functions.scalar import safe_name
from shelfspark.operators import features as FE
from shelfspark.operators.transform import split_by_date
from shelfspark.plans.catalog.base import CUT, register, sales_view, table, with_sales
from shelfspark.plans.retail import TESTDATA_PRESET as P
from shelfspark.plans.retail import clean_labels, feature_pipeline_apply, feature_pipeline_fit


def _lit(v) -> str:
    return "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v)


def _case(col: str, mapping: dict, default: str) -> str:
    return f"CASE {col} " + " ".join(f"WHEN {_lit(k)} THEN {_lit(v)}" for k, v in mapping.items()) + f" ELSE {default} END"


_TYPE = _case("Item_Type", P.type_recode, "Item_Type")
_FAT = (f"CASE WHEN {_TYPE} = {_lit(P.na_type_label)} THEN 'NA' "
        f"WHEN Item_Type IN ({', '.join(_lit(x) for x in P.no_fat_types)}) THEN 'NA' "
        f"ELSE {_case('Item_Fat_Content', P.fat_recode, 'Item_Fat_Content')} END")
_SIZE = (f"CASE WHEN Outlet_Identifier IN ({', '.join(_lit(x) for x in P.small_outlets)}) "
         f"THEN {_lit(P.small_label)} ELSE Outlet_Size END")

# SQL twin of clean_labels over a frame named {src}.
_CLEAN = """
SELECT l_orderkey, l_linenumber, Item_Identifier, Item_Weight, {fat} AS Item_Fat_Content, Item_Visibility,
       {typ} AS Item_Type, Item_MRP, Outlet_Identifier, CAST({year} - Outlet_Establishment_Year AS INTEGER) AS Outlet_Establishment_Year,
       Outlet_Size, Outlet_Location_Type, Outlet_Type, Item_Outlet_Sales, date_created
FROM {{src}}""".format(fat=_FAT, typ=_TYPE, year=P.ref_year)

_MODES = """
SELECT Item_Identifier, Item_Weight AS mode FROM (
  SELECT Item_Identifier, Item_Weight, row_number() OVER (PARTITION BY Item_Identifier ORDER BY count(*) DESC, Item_Weight) AS rn
  FROM {src} WHERE Item_Weight IS NOT NULL GROUP BY 1, 2) WHERE rn = 1"""

_GMODE = """
SELECT Item_Weight AS gmode FROM (SELECT Item_Weight, count(*) AS n FROM {src} WHERE Item_Weight IS NOT NULL GROUP BY 1)
ORDER BY n DESC, Item_Weight LIMIT 1"""

_BIN = ("CASE WHEN f.Item_MRP IS NULL THEN NULL WHEN f.Item_MRP <= k.c1 THEN 1 WHEN f.Item_MRP <= k.c2 THEN 2 "
        "WHEN f.Item_MRP <= k.c3 THEN 3 ELSE 4 END")

_ENCODE = """
SELECT f.l_orderkey, f.l_linenumber, f.Item_Weight, f.Item_Visibility, {bin} AS Item_MRP, f.Outlet_Establishment_Year,
       CAST({size_code} AS INTEGER) AS Outlet_Size, CAST({loc_code} AS INTEGER) AS Outlet_Location_Type,
       f.Item_Outlet_Sales, f.date_created, {dummies}
FROM {{src}} f, cuts k""".format(
    bin=_BIN,
    size_code=_case(f"({_SIZE.replace('Outlet_Identifier', 'f.Outlet_Identifier').replace('ELSE Outlet_Size', 'ELSE f.Outlet_Size')})", P.size_codes, "NULL"),
    loc_code=_case("f.Outlet_Location_Type", P.location_codes, "NULL"),
    dummies=", ".join(f"CAST(COALESCE(f.Outlet_Type = {_lit(t)}, false) AS INTEGER) AS Outlet_Type_{safe_name(t)}"
                      for t in P.outlet_types),
)

_TRAIN_CTES = f"""
, train_raw AS (SELECT * FROM sales WHERE date_created <= DATE '{CUT}')
, test_raw AS (SELECT * FROM sales WHERE date_created > DATE '{CUT}')
, train_clean AS ({_CLEAN.format(src='train_raw')})
, test_clean AS ({_CLEAN.format(src='test_raw')})
, train_modes AS ({_MODES.format(src='train_clean')})
, train_gmode AS ({_GMODE.format(src='train_clean')})
, gap_table AS (
    SELECT g.Item_Identifier, COALESCE(m.mode, (SELECT gmode FROM train_gmode)) AS mode
    FROM (SELECT DISTINCT Item_Identifier FROM train_clean WHERE Item_Weight IS NULL) g
    LEFT JOIN train_modes m ON g.Item_Identifier = m.Item_Identifier)
, train_filled AS (
    SELECT c.* REPLACE (COALESCE(c.Item_Weight, m.mode, 0.0) AS Item_Weight)
    FROM train_clean c LEFT JOIN train_modes m ON c.Item_Identifier = m.Item_Identifier)
, test_gmode AS ({_GMODE.format(src='test_clean')})
, test_filled AS (
    SELECT c.* REPLACE (COALESCE(c.Item_Weight, t.mode, (SELECT gmode FROM test_gmode)) AS Item_Weight)
    FROM test_clean c LEFT JOIN gap_table t ON c.Item_Identifier = t.Item_Identifier)
, cuts AS (SELECT quantile_cont(Item_MRP, 0.25) AS c1, quantile_cont(Item_MRP, 0.5) AS c2,
                  quantile_cont(Item_MRP, 0.75) AS c3 FROM train_filled)
, train_feat AS ({_ENCODE.format(src='train_filled')})
, test_feat AS ({_ENCODE.format(src='test_filled')})
"""


def _split(spark, d, columns):
    return split_by_date(sales_view(spark, d, [*columns, "date_created"]), "date_created", CUT)


_WEIGHT = ["l_orderkey", "l_linenumber", "Item_Identifier", "Item_Weight"]
_PRICE = ["l_orderkey", "l_linenumber", "Item_MRP"]


def _fit(spark, d):
    """Fit on the reference period. Nothing stays pinned: the chain aggregates the view once for the modes and
    once for the cuts, each pass reading only the columns it needs."""
    train, test = split_by_date(sales_view(spark, d), "date_created", CUT)
    feats, params = feature_pipeline_fit(train, P, materialize_as="none")
    return train, test, feats, params


def _apply(test, params):
    return feature_pipeline_apply(test, P, params, materialize_as="none")


@register("mode_impute_fit", with_sales(_TRAIN_CTES + "SELECT Item_Identifier, mode FROM gap_table"))
def q_mode_impute_fit(spark, d):
    train, _ = _split(spark, d, _WEIGHT)
    _, imp = FE.mode_impute_fit(clean_labels(train, P), "Item_Identifier", "Item_Weight")
    return imp.table


@register("mode_impute_apply", with_sales(
    _TRAIN_CTES + "SELECT l_orderkey, l_linenumber, Item_Identifier, Item_Weight FROM test_filled"))
def q_mode_impute_apply(spark, d):
    train, test = _split(spark, d, _WEIGHT)
    _, imp = FE.mode_impute_fit(clean_labels(train, P), "Item_Identifier", "Item_Weight")
    out = imp.apply(clean_labels(test, P))
    return out.select("l_orderkey", "l_linenumber", "Item_Identifier", "Item_Weight")


@register("mode_impute_overwrite", with_sales(f"""
, modes AS ({_MODES.format(src='sales')})
, gaps AS (SELECT DISTINCT Item_Identifier FROM sales WHERE Item_Weight IS NULL)
SELECT s.l_orderkey, s.l_linenumber, s.Item_Identifier,
       CASE WHEN g.Item_Identifier IS NOT NULL THEN COALESCE(m.mode, s.Item_Weight) ELSE s.Item_Weight END AS Item_Weight
FROM sales s LEFT JOIN gaps g ON s.Item_Identifier = g.Item_Identifier
LEFT JOIN modes m ON s.Item_Identifier = m.Item_Identifier"""))
def q_mode_impute_overwrite(spark, d):
    s = sales_view(spark, d, ["l_orderkey", "l_linenumber", "Item_Identifier", "Item_Weight"])
    return FE.mode_impute_overwrite(s, "Item_Identifier", "Item_Weight")


@register("quantile_bin_fit", with_sales(" UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS p, round(quantile_cont(Item_MRP, {p}), 6) AS cut FROM sales WHERE date_created <= DATE '{CUT}'"
    for p in ("0.0", "0.25", "0.5", "0.75", "1.0"))))
def q_quantile_bin_fit(spark, d):
    train, _ = _split(spark, d, _PRICE)
    cuts = FE.quantile_bin_fit(train, "Item_MRP", 4)
    return spark.createDataFrame([(i / 4, round(c, 6)) for i, c in enumerate(cuts)], "p double, cut double")


@register("quantile_bin_apply", with_sales(f"""
, cuts AS (SELECT quantile_cont(Item_MRP, 0.25) AS c1, quantile_cont(Item_MRP, 0.5) AS c2,
                  quantile_cont(Item_MRP, 0.75) AS c3 FROM sales WHERE date_created <= DATE '{CUT}')
SELECT f.l_orderkey, f.l_linenumber, f.Item_MRP, {_BIN} AS price_bin
FROM (SELECT * FROM sales WHERE date_created > DATE '{CUT}') f, cuts k"""))
def q_quantile_bin_apply(spark, d):
    train, test = _split(spark, d, _PRICE)
    cuts = FE.quantile_bin_fit(train, "Item_MRP", 4)
    return FE.quantile_bin_apply(test.select("l_orderkey", "l_linenumber", "Item_MRP"), "Item_MRP", cuts, out="price_bin")


@register("ordinal_encode", "SELECT o_orderkey, CAST(" + _case("o_orderpriority", P.size_codes, "NULL")
          + " AS INTEGER) AS o_orderpriority FROM orders")
def q_ordinal_encode(spark, d):
    return FE.ordinal_encode(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", P.size_codes)


@register("one_hot_fixed", "SELECT c_custkey, " + ", ".join(
    f"CAST(COALESCE(c_mktsegment = {_lit(t)}, false) AS INTEGER) AS segment_{safe_name(t)}" for t in P.outlet_types)
    + " FROM customer")
def q_one_hot_fixed(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return FE.one_hot_fixed(c, "c_mktsegment", list(P.outlet_types), prefix="segment")


_PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@register("one_hot_inferred", "SELECT p_partkey, " + ", ".join(
    f"CAST(COALESCE(p_type = {_lit(t)}, false) AS INTEGER) AS p_type_{safe_name(t)}" for t in _PART_TYPES)
    + " FROM part")
def q_one_hot_inferred(spark, d):
    out, _ = FE.one_hot_inferred(table(spark, d, "part").select("p_partkey", "p_type"), "p_type")
    return out


_LABELS = "SELECT label, row_number() OVER (ORDER BY label) - 1 AS idx FROM (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS label FROM lineitem)"


@register("one_hot_sparse", f"""
WITH labels AS ({_LABELS})
SELECT l_orderkey, l_linenumber, CAST(idx AS BIGINT) AS one, CAST(1 AS INTEGER) AS n_ones FROM lineitem JOIN labels ON CAST(l_partkey AS VARCHAR) = label""")
def q_one_hot_sparse(spark, d):
    """Part keys as labels: as many as there are parts, so the ones are places, not columns."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"))
    return FE.one_hot_sparse(li, "part").select("l_orderkey", "l_linenumber", F.col("part_ones")[0].alias("one"), F.size("part_ones").alias("n_ones"))


@register("crosstab_long", f"""
WITH labels AS ({_LABELS}), c AS (SELECT l_returnflag, CAST(l_partkey AS VARCHAR) AS part, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, part, CAST(idx AS BIGINT) AS col_index, n FROM c JOIN labels ON part = label""")
def q_crosstab_long(spark, d):
    """Return flags against part keys, which a pivot could not hold as columns."""
    li = table(spark, d, "lineitem").select("l_returnflag", F.col("l_partkey").cast("string").alias("part"))
    return FE.crosstab_long(li, "l_returnflag", "part")


@register("feature_pipeline_fit", with_sales(_TRAIN_CTES + "SELECT * FROM train_feat"))
def q_feature_pipeline_fit(spark, d):
    _, _, feats, _ = _fit(spark, d)
    return feats


@register("feature_pipeline_apply", with_sales(_TRAIN_CTES + "SELECT * FROM test_feat"))
def q_feature_pipeline_apply(spark, d):
    _, test, _, params = _fit(spark, d)
    return _apply(test, params)


@register("feature_bins_report", with_sales(_TRAIN_CTES + """
SELECT 'train' AS "Set", Item_MRP, count(*) AS n, round(avg(Item_Outlet_Sales), 4) AS mean_sales,
       round(avg(Item_Weight), 4) AS mean_weight FROM train_feat GROUP BY Item_MRP
UNION ALL
SELECT 'test' AS "Set", Item_MRP, count(*) AS n, round(avg(Item_Outlet_Sales), 4) AS mean_sales,
       round(avg(Item_Weight), 4) AS mean_weight FROM test_feat GROUP BY Item_MRP"""))
def q_feature_bins_report(spark, d):
    """Flagship: fit on the reference period, apply to the new rows, mean sales per price bin."""
    _, test, feats, params = _fit(spark, d)
    applied = _apply(test, params)

    def rep(df, tag):
        return df.groupBy("Item_MRP").agg(
            F.count(F.lit(1)).alias("n"), F.round(F.avg("Item_Outlet_Sales"), 4).alias("mean_sales"),
            F.round(F.avg("Item_Weight"), 4).alias("mean_weight")).select(F.lit(tag).alias("Set"), "*")

    return rep(feats, "train").unionByName(rep(applied, "test"))
