"""Mapping of the supplied TPC-H-like tables onto the items/outcomes shape.

The library itself is column-name agnostic.  These expressions define the
test fixture once, as SQL text that Spark ``selectExpr`` and DuckDB both
accept, so the Spark side and the oracle read exactly the same input
(:func:`outcomes_of` computes OUTCOME_EXPRS in fewer aggregates; a test compares them).

items   (one row per order)  : orders x customer x nation
outcomes(one row per order)  : lineitem rolled up per order
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomelab.sources.tables import read_table

# Fixed values of the fixture (dates, split share).
DATE_FLOOR = "1996-01-01"      # items before this date are dropped (O9)
RECENT_FROM = "1998-07-01"     # train rows before this date leave train (O10)
DEV_SHARE = 0.2                # last 20 % of items by (date, id) are dev (O64)

ITEM_EXPRS = [
    "o_orderkey AS id",
    "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_custkey END AS teacher",
    "n_name || '-' || CAST(c_custkey % 5 AS STRING) AS school",
    "CAST(o_orderdate AS DATE) AS d",
    "o_totalprice AS price",
    "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS area",
    "o_orderstatus AS subject",
    "c_mktsegment AS resource",
    "CAST(c_custkey % 3 AS DOUBLE) * 5.0 + 30.0 AS labor",
    "CASE c_custkey % 4 WHEN 0 THEN 'Mrs.' WHEN 1 THEN 'Ms.' WHEN 2 THEN 'Mr.' ELSE NULL END AS prefix",
    "CASE n_regionkey WHEN 0 THEN 'urban' WHEN 1 THEN 'suburban' WHEN 2 THEN 'rural' ELSE NULL END AS metro",
    "'C' || CAST(c_custkey % 7 AS STRING) AS city",
    "n_name AS state",
    "c_acctbal AS latitude",
    "-1.0 * CAST(c_nationkey * 4 + c_custkey % 4 AS DOUBLE) AS longitude",
]

OUTCOME_EXPRS = [
    "l_orderkey AS id",
    "sum(l_extendedprice) > 250000 AS label",
    "max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) = 1 AS flag_r",
    "CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE max(l_discount) >= 0.09 END AS flag_disc",
    "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE max(l_quantity) >= 48 END AS flag_qty",
    "count(*) >= 6 AS flag_big",
    # "min(l_linestatus) = 'O'" written with boolean aggregates so the
    # roll-up stays a hash aggregate (a string min forces a sort aggregate)
    "CASE WHEN l_orderkey % 5 = 0 THEN NULL "
    "ELSE bool_and(l_linestatus >= 'O') AND bool_or(l_linestatus = 'O') END AS flag_open",
    "CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE max(l_tax) >= 0.08 END AS flag_tax",
    "CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE sum(l_quantity) >= 150 END AS flag_ship",
]

# Outcome columns imputed by their mode, and the three OR-ed into one label.
MODE_IMPUTED = ["flag_disc", "flag_qty", "flag_open", "flag_tax", "flag_ship"]
OR_PARTS = ["flag_open", "flag_tax", "flag_ship"]
OR_LABEL = "one_or_more"
# The six labels studied; the first one is the main label.
LABELS = ["label", "flag_r", "flag_disc", "flag_qty", "flag_big", "one_or_more"]

ITEM_SQL = ("SELECT " + ", ".join(ITEM_EXPRS) +
            " FROM orders JOIN customer ON o_custkey = c_custkey"
            " JOIN nation ON c_nationkey = n_nationkey")
OUTCOME_SQL = "SELECT " + ", ".join(OUTCOME_EXPRS) + " FROM lineitem GROUP BY l_orderkey"


def items(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    customer = read_table(spark, folder, "customer")
    nation = read_table(spark, folder, "nation")
    joined = (orders.join(customer, orders.o_custkey == customer.c_custkey)
              .join(nation, customer.c_nationkey == nation.n_nationkey))
    return joined.selectExpr(*ITEM_EXPRS)


# The yes/no parts of OUTCOME_EXPRS, as conditions on one line: a bit each
LINE_BITS = ["l_returnflag = 'R'", "l_discount >= 0.09", "l_discount IS NOT NULL",
             "l_quantity >= 48", "l_quantity IS NOT NULL", "l_tax >= 0.08", "l_tax IS NOT NULL",
             "l_linestatus < 'O'", "l_linestatus = 'O'", "l_linestatus IS NOT NULL"]


def outcomes_of(lineitem: DataFrame) -> DataFrame:
    """The roll-up of OUTCOME_EXPRS.  Extremes that are only compared with a number
    are known from their lines' comparisons, so those travel as bits of one integer:
    four aggregates a row instead of ten."""
    bits = " | ".join(f"(CASE WHEN {c} THEN {1 << i} ELSE 0 END)" for i, c in enumerate(LINE_BITS))
    per_order = lineitem.groupBy("l_orderkey").agg(
        F.sum("l_extendedprice").alias("_price"), F.sum("l_quantity").alias("_quantity"),
        F.count(F.lit(1)).alias("_lines"), F.expr(f"bit_or({bits})").alias("_bits"))

    def some(condition):
        return f"(_bits & {1 << LINE_BITS.index(condition)}) <> 0"

    def known(column, then, gap):
        return (f"CASE WHEN l_orderkey % {gap} = 0 THEN NULL "
                f"WHEN {some(column + ' IS NOT NULL')} THEN {then} ELSE NULL END")

    return per_order.selectExpr(
        "l_orderkey AS id",
        "_price > 250000 AS label",
        f"{some(LINE_BITS[0])} AS flag_r",
        f"{known('l_discount', some('l_discount >= 0.09'), 11)} AS flag_disc",
        f"{known('l_quantity', some('l_quantity >= 48'), 7)} AS flag_qty",
        "_lines >= 6 AS flag_big",
        known("l_linestatus", f"NOT {some(LINE_BITS[7])} AND {some(LINE_BITS[8])}", 5) + " AS flag_open",
        f"{known('l_tax', some('l_tax >= 0.08'), 3)} AS flag_tax",
        "CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE _quantity >= 150 END AS flag_ship")


def outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return outcomes_of(read_table(spark, folder, "lineitem"))
