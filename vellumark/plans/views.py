"""Catalogue-shaped views over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread
from ..sources.catalogue import table


def raw_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a raw text catalogue with the usual flaws.

    Markets give list-valued, blank, absent and padded countries; priorities
    give years that do not parse and dates in another format.
    """
    orders = spread(table(spark, folder, "orders"))
    customer = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    # Nation and region are fixed lists, not growing tables.
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name"
    )
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        places, F.col("c_nationkey") == F.col("n_nationkey")
    )
    segment, priority = F.col("c_mktsegment"), F.col("o_orderpriority")
    country = (
        F.when(segment == "BUILDING", F.concat("n_name", F.lit(", "), "r_name"))
        .when(segment == "MACHINERY", "")
        .when(segment == "FURNITURE", None)
        .when(segment == "AUTOMOBILE", F.concat(F.lit(" , "), "n_name"))
        .otherwise(F.concat(F.lit("  "), "n_name"))
    )
    year = (F.year("o_orderdate") + 19).cast("string")
    added = F.when(priority == "2-HIGH", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(
        F.concat(F.lit(" "), F.date_format("o_orderdate", "MMMM d, yyyy"), F.lit(" "))
    )
    thousands = F.floor(F.col("o_totalprice") / 1000).cast("string")
    duration = (
        F.when(F.col("o_orderstatus") == "F", F.concat(thousands, F.lit(" min")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("about "), thousands, F.lit(" of 9")))
        .otherwise("unknown")
    )
    return rows.select(
        F.col("o_orderkey").cast("string").alias("show_id"),
        F.nullif("o_orderstatus", F.lit("P")).alias("type"),
        F.nullif("c_name", F.lit("")).alias("title"),
        country.alias("country"),
        F.when(priority == "4-NOT SPECIFIED", "unknown").otherwise(year).alias("release_year"),
        F.nullif(priority, F.lit("5-LOW")).alias("rating"),
        added.alias("date_added"),
        duration.alias("duration"),
        segment.alias("listed_in"),
        F.concat_ws(" ", priority, F.lit("order of"), "c_name").alias("description"),
    )


def document_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as cleaned catalogue rows with whole texts."""
    documents = spread(table(spark, folder, "documents"))
    name = F.concat_ws(" ", "source", F.col("doc_id").cast("string"))
    return documents.select(
        F.col("doc_id").cast("string").alias("content_id"),
        F.when(F.col("source") != "src0", name).alias("title"),
        F.col("lang").alias("content_type"),
        F.col("source").alias("country"),
        F.nullif("lang", F.lit("en")).alias("listed_in"),
        F.col("text").alias("description"),
    )


def vector_items(spark: SparkSession, folder: str) -> DataFrame:
    """Given embeddings as items with a group label."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("string").alias("content_id"),
        F.concat_ws(" ", F.lit("vector"), F.col("vec_id").cast("string")).alias("title"),
        F.concat(F.lit("group "), F.col("label").cast("string")).alias("content_type"),
        F.col("label").alias("topic_cluster"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
