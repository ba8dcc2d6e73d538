"""Usage tables over the given parquet files.

Every function returns a lazy DataFrame. The small dimension side is joined first and the
large fact table last, so the fact table is shuffled once, on its evenly spread order key,
and never on the account key, which may be hot.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .. import config as C
from ..functions.money import AMOUNT
from .shared import shared


@shared
def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _unit_columns(region: Column, segment: Column, nation: Column) -> list[Column]:
    unit = F.when(region.isin(*C.FOLDED_REGIONS), region).otherwise(F.concat(region, F.lit(" "), segment))
    return [unit.alias("unit"), F.concat(region, F.lit("_"), nation).alias("sub_unit")]


@shared
def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per account: name, balance and unit columns."""
    customer = read(spark, sf_dir, "customer")
    nation = read(spark, sf_dir, "nation")
    region = read(spark, sf_dir, "region").select(
        "r_regionkey", F.replace("r_name", F.lit(" "), F.lit("_")).alias("region"))
    joined = (customer.join(nation, customer.c_nationkey == nation.n_nationkey)
              .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    return joined.select(
        F.col("c_custkey"),
        F.col("c_custkey").cast("string").alias("account_id"),
        F.col("c_name").alias("account_name"),
        F.col("c_acctbal").alias("account_balance"),
        "region",
        F.col("c_mktsegment").alias("segment"),
        *_unit_columns(F.col("region"), F.col("c_mktsegment"), F.col("n_name")),
    )


@shared
def daily_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metered usage by day and account; the main fact table."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    lineitem = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linestatus", "l_returnflag", "l_shipdate", "l_extendedprice", "l_discount")
    owned = orders.join(accounts(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
    return lineitem.join(owned, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.to_date("l_shipdate").alias("date"),
        "account_id", "account_name",
        F.col("l_linestatus").alias("platform"),
        "region", "segment", "unit", "sub_unit",
        F.col("l_returnflag").alias("kind"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast(AMOUNT).alias("dollars"),
        F.col("o_orderpriority").alias("priority"),
        "account_balance",
    )


def _monthly(spark: SparkSession, sf_dir: str, which: Column) -> DataFrame:
    owners = accounts(spark, sf_dir).where(which)
    orders = read(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return orders.join(owners, F.col("o_custkey") == F.col("c_custkey")).select(
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        "account_id", "account_name",
        F.col("o_orderstatus").alias("platform"),
        "region", "segment", "unit", "sub_unit",
        F.col("o_orderpriority").alias("kind"),
        F.col("o_totalprice").cast(AMOUNT).alias("dollars"),
    )


@shared
def monthly_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly usage of accounts on private contracts: the upper third of the balances."""
    return _monthly(spark, sf_dir, F.col("account_balance") >= C.PRIVATE_FROM)


@shared
def monthly_public(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly usage of public accounts: the lower third of the balances."""
    return _monthly(spark, sf_dir, F.col("account_balance") < C.PUBLIC_BELOW)


def _plain(row: tuple) -> list:
    """Structs of a rule (tuples) as dictionaries."""
    return [{f"c{i - 1}" if i else "shape": x for i, x in enumerate(v)} if isinstance(v, tuple) else v for v in row]


def rule_table(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A config table of any size.

    It goes to Spark as an Arrow table, whose size Spark knows: a small one is broadcast by the usual
    threshold, a large one is joined like any other table.
    """
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    names = kind.fieldNames()
    table = pa.Table.from_pylist([dict(zip(names, _plain(r))) for r in rows], schema=to_arrow_schema(kind))
    return spark.createDataFrame(table, schema=kind)


def feature_catalog(spark: SparkSession) -> DataFrame:
    return rule_table(spark, list(C.FEATURE_CATALOG), "feature string, kind string, in_use int")


def curves(spark: SparkSession) -> DataFrame:
    """One row per unit; one struct of curve settings per cohort."""
    curve = T.StructType([T.StructField("shape", T.StringType())]
                         + [T.StructField(f"c{i}", T.DoubleType()) for i in range(5)])
    schema = T.StructType([T.StructField("unit", T.StringType())]
                          + [T.StructField(f"curve_{y}", curve) for y in C.CURVE_COHORTS])
    by_unit: dict[str, dict[int, tuple]] = {}
    for unit, cohort, *settings in C.CURVES:
        by_unit.setdefault(unit, {})[cohort] = tuple(settings)
    rows = [(unit, *[by_unit[unit][y] for y in C.CURVE_COHORTS]) for unit in by_unit]
    return rule_table(spark, rows, schema)

