"""The driver's parquet tables and the retail view mapped onto them.

Column roles follow the raw sales record (Item_* / Outlet_* names); the
mapping onto the TPC-H-like tables is the one in FIXTURES.md.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# Dimensions each view column needs (lineitem alone serves the others).
_NEEDS = {
    "Item_Identifier": ("part",),
    "Item_Weight": ("part",),
    "Item_Type": ("part",),
    "Item_MRP": ("part",),
    "Outlet_Establishment_Year": ("orders",),
    "Outlet_Size": ("orders",),
    "Outlet_Type": ("orders", "customer"),
    "Outlet_Location_Type": ("supplier",),
    "date_created": ("orders",),
}

VIEW_COLUMNS = (
    "l_orderkey", "l_linenumber", "Item_Identifier", "Item_Weight", "Item_Fat_Content", "Item_Visibility",
    "Item_Type", "Item_MRP", "Outlet_Identifier", "Outlet_Establishment_Year", "Outlet_Size",
    "Outlet_Location_Type", "Outlet_Type", "Item_Outlet_Sales", "date_created",
)


def sales_view(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per lineitem with the raw sales-record columns (all, or the listed ones).

    Only the dimensions the requested columns come from are joined. Every
    dimension key is unique (orders, part, supplier, customer, nation and region
    keys are primary keys), so a left join adds columns and never rows, and
    leaving out an unused one changes no row. Catalyst cannot drop such a join by
    itself (it knows no keys), and at scale each dropped join is one shuffle of
    lineitem less.

    Join plan: geography (nation, region: fixed tiny tables, broadcast by the
    planner's size estimate) onto supplier; customer onto orders; then lineitem
    against orders, part and supplier. The big joins are left to Catalyst/AQE:
    sort-merge by key at scale, broadcast at runtime when a side turns out small.
    """
    cols = list(columns) if columns is not None else list(VIEW_COLUMNS)
    unknown = [c for c in cols if c not in VIEW_COLUMNS]
    if unknown:
        raise ValueError(f"not view columns: {unknown}")
    need = {d for c in cols for d in _NEEDS.get(c, ())}
    t = lambda n: table(spark, sf_dir, n)
    j = t("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_discount", "l_extendedprice"
    )
    if "orders" in need:
        orders = t("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        if "customer" in need:
            orders = orders.join(t("customer").select("c_custkey", "c_mktsegment"),
                                 F.col("o_custkey") == F.col("c_custkey"), "left")
        j = j.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if "part" in need:
        part = t("part").select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
        j = j.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    if "supplier" in need:
        # Geography: no hint; the planner broadcasts it from its file size and AQE re-checks
        # at runtime (both size checks), so no extra counting job per view.
        geo = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left").select("n_nationkey", "r_name")
        supp = t("supplier").select("s_suppkey", "s_nationkey").join(geo, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        j = j.join(supp, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    exprs = {
        "l_orderkey": F.col("l_orderkey"),
        "l_linenumber": F.col("l_linenumber"),
        "Item_Identifier": F.col("p_brand"),
        "Item_Weight": F.when(F.col("p_partkey") % 6 == 0, F.lit(None).cast("double")).otherwise(F.col("p_size").cast("double")),
        "Item_Fat_Content": F.col("l_returnflag"),
        "Item_Visibility": F.col("l_discount"),
        "Item_Type": F.col("p_type"),
        "Item_MRP": F.col("p_retailprice"),
        "Outlet_Identifier": F.col("l_suppkey"),
        "Outlet_Establishment_Year": F.year("o_orderdate").cast("int"),
        "Outlet_Size": F.col("o_orderpriority"),
        "Outlet_Location_Type": F.col("r_name"),
        "Outlet_Type": F.col("c_mktsegment"),
        "Item_Outlet_Sales": F.col("l_extendedprice") * (1 - F.col("l_discount")),
        "date_created": F.to_date("o_orderdate"),
    }
    return j.select(*[exprs[c].alias(c) for c in cols])


# The same view in SQL, for the DuckDB oracle (prefix of every oracle query that uses it).
SALES_CTE = """
sales AS (
  SELECT l.l_orderkey, l.l_linenumber,
         p.p_brand AS Item_Identifier,
         CASE WHEN p.p_partkey % 6 = 0 THEN NULL ELSE CAST(p.p_size AS DOUBLE) END AS Item_Weight,
         l.l_returnflag AS Item_Fat_Content,
         l.l_discount AS Item_Visibility,
         p.p_type AS Item_Type,
         p.p_retailprice AS Item_MRP,
         l.l_suppkey AS Outlet_Identifier,
         CAST(year(o.o_orderdate) AS INTEGER) AS Outlet_Establishment_Year,
         o.o_orderpriority AS Outlet_Size,
         r.r_name AS Outlet_Location_Type,
         c.c_mktsegment AS Outlet_Type,
         l.l_extendedprice * (1 - l.l_discount) AS Item_Outlet_Sales,
         CAST(o.o_orderdate AS DATE) AS date_created
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
)
"""
