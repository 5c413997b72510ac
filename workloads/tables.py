"""Contracts and marts over the given Parquet tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from martflow.operators import (
    DAILY_CATEGORY_MART,
    CountDistinct,
    Lookup,
    MartSpec,
    Money,
    Ratio,
    Sum,
)
from martflow.sources import ORDER_RULES, Contract, Rule, finite_rule, read_contract

EVENT_FILE = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StringType()),
    ]
)

#: Events in the shape of raw orders.
EVENT_ORDERS = Contract(
    schema=StructType(
        [
            StructField("order_id", LongType()),
            StructField("customer_id", LongType()),
            StructField("order_ts", TimestampNTZType()),
            StructField("category", StringType()),
            StructField("quantity", IntegerType()),
            StructField("unit_price", DoubleType()),
        ]
    ),
    key=("order_id",),
    time="order_ts",
    rules=ORDER_RULES,
)

#: Order lines with repeated keys: versions of a line lie in different months.
LINES = Contract(
    schema=StructType(
        [
            StructField("l_orderkey", LongType()),
            StructField("l_linenumber", IntegerType()),
            StructField("l_partkey", LongType()),
            StructField("l_suppkey", LongType()),
            StructField("l_shipdate", TimestampNTZType()),
            StructField("l_returnflag", StringType()),
            StructField("l_quantity", DoubleType()),
            StructField("l_extendedprice", DoubleType()),
        ]
    ),
    key=("l_orderkey", "l_linenumber"),
    time="l_shipdate",
    tiebreak=("l_partkey", "l_suppkey"),
    day="ship_month",
    day_of="trunc(to_date(l_shipdate), 'MM')",
    rules=(
        Rule("order_present", "l_orderkey IS NOT NULL"),
        Rule("line_present", "l_linenumber IS NOT NULL"),
        Rule("quantity_positive", "l_quantity > 0"),
        Rule("price_positive", "l_extendedprice > 0"),
        finite_rule("revenue_finite", "l_extendedprice"),
        Rule("time_present", "l_shipdate IS NOT NULL"),
    ),
)

MONTHLY_FLAG_MART = MartSpec(
    day="ship_month",
    grain=("ship_month", "l_returnflag"),
    measures=(
        Money("total_revenue", "revenue"),
        CountDistinct("orders", "l_orderkey"),
        CountDistinct("parts", "l_partkey"),
        Sum("units", "l_quantity"),
        Ratio("avg_order_value", "total_revenue", "orders"),
    ),
    derived={"revenue": lambda: F.col("l_extendedprice")},
)

DAILY_BRAND_MART = MartSpec(
    day="order_date",
    grain=("order_date", "p_brand"),
    measures=(
        Money("total_revenue", "revenue"),
        CountDistinct("orders", "l_orderkey"),
        CountDistinct("customers", "o_custkey"),
        Sum("units", "l_quantity"),
        Ratio("avg_order_value", "total_revenue", "orders"),
    ),
    derived=MONTHLY_FLAG_MART.derived,
    determines={"l_orderkey": ("o_custkey",)},
)

DAILY_COUNTRY_MART = replace(
    DAILY_CATEGORY_MART,
    grain=("order_date", "country"),
    lookup=Lookup("customer_id", "customer_id", ("country",)),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def event_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Raw orders: not yet validated, day column not yet derived."""
    events = read_contract(spark, f"{folder}/events.parquet", EVENT_FILE, "parquet")
    # json_tuple is a generator, so a filter on its output does not parse the text again.
    parsed = events.select("event_id", "user_id", "ts", "event_type", "value", F.json_tuple("props", "k").alias("k"))
    return parsed.select(
        F.col("event_id").alias("order_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("order_ts"),
        F.col("event_type").alias("category"),
        F.col("k").try_cast("int").alias("quantity"),
        F.col("value").alias("unit_price"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("country")
    )


def lines(spark: SparkSession, folder: str) -> DataFrame:
    return read_contract(spark, f"{folder}/lineitem.parquet", LINES.schema, "parquet")
