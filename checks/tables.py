"""Inputs shared by the queries, with the same derivations as SQL for the oracle.

The tables hold no missing values, so gaps are made by key, the same way on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableloom.functions.columns import col, null_every

LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to the given digits (``rint`` stays in generated code, ``round`` goes by decimals)."""
    scale = float(10**digits)
    return df.select(*[
        (F.rint(col(f.name) * scale) / scale).alias(f.name) if isinstance(f.dataType, T.DoubleType) else col(f.name)
        for f in df.schema.fields
    ])


def gapped_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem")
    return df.select(
        *LINE_KEYS,
        null_every(F.col("l_quantity"), F.col("l_partkey"), 17, 3).alias("l_quantity"),
        "l_extendedprice",
        F.when(F.col("l_orderkey") % 3 == 0, F.col("l_discount")).alias("l_discount"),
        null_every(F.col("l_tax"), F.col("l_suppkey"), 13, 2).alias("l_tax"),
        null_every(F.col("l_returnflag"), F.col("l_partkey"), 19, 4).alias("l_returnflag"),
        "l_linestatus",
    )


GAPPED_LINEITEM = """(SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
 CASE WHEN l_partkey % 17 <> 3 THEN l_quantity END AS l_quantity, l_extendedprice,
 CASE WHEN l_orderkey % 3 = 0 THEN l_discount END AS l_discount,
 CASE WHEN l_suppkey % 13 <> 2 THEN l_tax END AS l_tax,
 CASE WHEN l_partkey % 19 <> 4 THEN l_returnflag END AS l_returnflag, l_linestatus
 FROM lineitem)"""


def gapped_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return df.select(
        "p_partkey", "p_name",
        null_every(F.col("p_brand"), key, 23, 5).alias("p_brand"),
        null_every(F.col("p_type"), key, 19, 3).alias("p_type"),
        null_every(F.col("p_size"), key, 17, 3).alias("p_size"),
        "p_retailprice",
    )


GAPPED_PART = """(SELECT p_partkey, p_name,
 CASE WHEN p_partkey % 23 <> 5 THEN p_brand END AS p_brand,
 CASE WHEN p_partkey % 19 <> 3 THEN p_type END AS p_type,
 CASE WHEN p_partkey % 17 <> 3 THEN p_size END AS p_size, p_retailprice FROM part)"""


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the labelled documents; ``quality`` is the target."""
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "n_chars",
        F.size(F.split("text", " ")).alias("n_words"),
        F.size(F.split("text", "\n")).alias("n_lines"),
    )
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic", "quality")
    return documents.join(labels, "doc_id")


def customer_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their orders' totals; ``order_total`` is the target."""
    totals = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("order_total"),
        F.max("o_totalprice").alias("largest_order"),
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return customers.join(totals, "c_custkey")
