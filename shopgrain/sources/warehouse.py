"""Star-schema Parquet tables presented as bronze tables.

Maps parts, customers, orders with line items, and events to the shape of the
bronze documents, so every plan can run over an existing warehouse.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import nest_items

# Device names by the remainder of an event's k property.
DEVICES = ("desktop", "mobile", "tablet")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def paths(folder: str) -> list[str]:
    """The tables that ``bronze`` reads and that grow, for the size of shuffles."""
    return [f"{folder.rstrip('/')}/{n}.parquet" for n in ("part", "customer", "orders", "lineitem", "events")]


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("title"),
        F.col("p_retailprice").cast("string").alias("price"),
        F.col("p_brand").alias("description"),
        F.col("p_type").alias("category"),
        F.concat(F.lit("/img/"), "p_partkey", F.lit(".jpg")).alias("image"),
        F.struct(
            (F.col("p_size") % 5 + 0.5).cast("double").alias("rate"),
            (F.col("p_size") * 10).cast("bigint").alias("count"),
        ).alias("rating"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    people = table(spark, folder, "customer")
    joined = people.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(
        regions, F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    name = F.split("c_name", "#")
    return joined.select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lower("c_name"), F.lit("@email.com")).alias("email"),
        F.col("c_name").alias("username"),
        F.lit(None).cast("string").alias("password"),
        F.struct(name[0].alias("firstname"), name[1].alias("lastname")).alias("name"),
        F.struct(
            F.col("n_name").alias("city"),
            F.col("c_mktsegment").alias("street"),
            F.col("c_nationkey").cast("bigint").alias("number"),
            F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("zipcode"),
            F.struct(
                F.lit(None).cast("string").alias("lat"), F.lit(None).cast("string").alias("long")
            ).alias("geolocation"),
            F.col("r_name").alias("country"),
        ).alias("address"),
        F.col("c_name").alias("phone"),
    )


def order_headers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("userId"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.col("o_orderstatus").alias("status"),
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_partkey").alias("productId"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as documents, each with all its items; orders without items stay."""
    fields = {"productId": F.col("productId"), "quantity": F.col("quantity")}
    nested = nest_items(items(spark, folder), ["id"], fields, "products")
    return order_headers(spark, folder).join(nested, "id", "left").select(
        "id", "userId", "date", "products", "status"
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.get_json_object("props", "$.k").cast("int") % len(DEVICES)
    names = F.array(*[F.lit(d) for d in DEVICES])
    return table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        "user_id",
        F.lit(None).cast("string").alias("session_id"),
        F.lit(None).cast("bigint").alias("product_id"),
        F.lit(None).cast("string").alias("page_url"),
        F.lit(None).cast("string").alias("referrer"),
        F.element_at(names, kind + 1).alias("device"),
    )


def bronze(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "products": products(spark, folder),
        "customers": customers(spark, folder),
        "orders": orders(spark, folder),
        "events": events(spark, folder),
    }
