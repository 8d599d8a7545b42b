"""The driver's TPC-H-like tables seen as the five retail landing entities.

Every entity is a lazy DataFrame over the given parquet tables, so its work
grows with them. The mapping (one line per field) is mirrored in SQL by
``tierlake.oracle`` for the DuckDB cross-check; keep the two in step.

* sales      <- lineitem JOIN orders (every line has an order)
* customers  <- customer JOIN nation
* products   <- part
* stores     <- supplier JOIN nation JOIN region
* inventory  <- part
* feed       <- events (ordered change feed for SCD2 from events)

The data has no NULLs, so a few fields are made NULL by a rule on the key
(guest sales, online sales, missing tier ...) to exercise NULL semantics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions.measures import MONEY, PERCENT

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_unless(cond, value):
    return F.when(cond, value)


def sales(spark: SparkSession, sf_dir: str, by_order: bool = False) -> DataFrame:
    """``by_order``: all lines of an order lie in one task, dealt as the few columns read and
    not again by the join (were the orders broadcast, it would leave lines where they are)."""
    li = table(spark, sf_dir, "lineitem")
    if by_order:
        li = li.where(F.col("l_orderkey").isNotNull()).repartition("l_orderkey")
    o = table(spark, sf_dir, "orders")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("transaction_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("transaction_date"),
        _null_unless(F.col("l_suppkey") % 10 != 0, F.col("l_suppkey")).alias("store_id"),
        _null_unless(F.col("o_custkey") % 50 != 0, F.col("o_custkey")).alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast(T.IntegerType()).alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("unit_price"),
        (F.col("l_discount").cast(PERCENT) * 100).cast(PERCENT).alias("discount_pct"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("l_returnflag").alias("channel"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    # nation has 25 rows by definition of the schema: a fixed-size broadcast
    n = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    k = F.col("c_custkey")
    return j.select(
        k.alias("customer_id"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
        F.when(k % 13 == 0, F.concat(F.lit("user"), k.cast("string")))
        .otherwise(F.concat(F.lit("user"), k.cast("string"), F.lit("@mail.test"))).alias("email"),
        F.lit(None).cast(T.DateType()).alias("date_of_birth"),
        F.when(k % 3 == 0, "M").when(k % 3 == 1, "F").otherwise("O").alias("gender"),
        _null_unless(k % 11 != 0, F.col("c_mktsegment")).alias("loyalty_tier"),
        _null_unless(k % 17 != 0, F.floor("c_acctbal").cast(T.LongType())).alias("loyalty_points"),
        F.date_add(F.to_date(F.lit("2020-01-01")), (k % 1000).cast("int")).alias("registration_date"),
        F.col("n_name").alias("city"),
        F.lit(None).cast(T.StringType()).alias("state"),
        F.lit(None).cast(T.StringType()).alias("country"),
        (k % 2 == 0).alias("marketing_opt_in"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    price = F.col("p_retailprice").cast(MONEY)
    factor = (k % 7).cast(T.DecimalType(3, 0)) * F.lit(0.10).cast(T.DecimalType(2, 2)) + F.lit(0.40).cast(T.DecimalType(2, 2))
    return p.select(
        k.alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.when(F.col("p_size") < 10, "small").when(F.col("p_size") < 30, "medium")
        .otherwise("large").alias("subcategory"),
        F.col("p_brand").alias("brand"),
        F.concat(F.lit("SKU-"), k.cast("string")).alias("sku"),
        F.round(price * factor, 2).cast(MONEY).alias("unit_cost"),
        F.when(k % 97 == 0, F.lit(0).cast(MONEY)).otherwise(price).alias("unit_price"),
        F.lit(None).cast(T.DoubleType()).alias("weight_kg"),
        (F.col("p_size") < 10).alias("is_perishable"),
        (k % 20 != 0).alias("is_active"),
        F.lit(None).cast(T.DateType()).alias("launch_date"),
        F.lit(None).cast(T.LongType()).alias("supplier_id"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    # nation (25 rows) and region (5 rows) are fixed-size: safe to broadcast
    n = F.broadcast(table(spark, sf_dir, "nation"))
    r = F.broadcast(table(spark, sf_dir, "region"))
    j = s.join(n, s.s_nationkey == n.n_nationkey, "left").join(r, F.col("n_regionkey") == r.r_regionkey, "left")
    return j.select(
        F.col("s_suppkey").alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.when(F.col("s_acctbal") < 0, "outlet").otherwise("standard").alias("store_type"),
        F.col("n_name").alias("city"),
        F.lit(None).cast(T.StringType()).alias("state"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("country"),
        F.lit(None).cast(T.DateType()).alias("open_date"),
        F.lit(None).cast(T.IntegerType()).alias("area_sqm"),
        F.lit(None).cast(T.IntegerType()).alias("num_employees"),
        (F.col("s_acctbal") >= 0).alias("is_active"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        k.alias("inventory_id"),
        (k % 10).alias("store_id"),
        k.alias("product_id"),
        (F.col("p_size") - 5).alias("quantity_on_hand"),
        (F.col("p_size") % 3).alias("quantity_reserved"),
        F.lit(0).alias("quantity_on_order"),
        F.lit(10).alias("reorder_point"),
        F.lit(50).alias("reorder_quantity"),
        F.lit(None).cast(T.DateType()).alias("last_restock_date"),
        F.lit(None).cast(T.TimestampType()).alias("last_updated"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def customer_snapshot_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later customer extract derived from ``customers`` by rules on the key:
    points +100 where key % 7 = 0, city NULL where key % 19 = 0 (a
    value -> NULL change), keys with key % 23 = 0 gone, and keys with
    key % 29 = 0 re-issued as new keys (+10,000,000)."""
    c = customers(spark, sf_dir)
    k = F.col("customer_id")
    later = (
        c.filter(k % 23 != 0)
        .withColumn("loyalty_points",
                    F.when(k % 7 == 0, F.col("loyalty_points") + 100).otherwise(F.col("loyalty_points")))
        .withColumn("city", F.when(k % 19 == 0, F.lit(None).cast(T.StringType())).otherwise(F.col("city")))
    )
    new_keys = c.filter(k % 29 == 0).withColumn("customer_id", k + 10_000_000)
    return later.unionByName(new_keys)


def _prefixed(c: str, prefix: str):
    return F.when(F.col(c).isNotNull(), F.concat(F.lit(prefix), F.col(c).cast("string"))).alias(c)


def write_landing(spark: SparkSession, sf_dir: str, landing_root: str) -> None:
    """Write the five entities as landing CSV files with string ids (TXN-, ORD-,
    CUST-, PRD-, STR- prefixes), as an upstream system would deliver them.
    Sales land in year folders, gzipped: they are dealt by order, and each task writes
    its lines of a year as one file. Every duplicate of a transaction id belongs to one
    order, hence to one file, and no task writes a whole year."""
    root = landing_root.rstrip("/")
    s = sales(spark, sf_dir, by_order=True)
    y = F.year("transaction_date")
    (s.select(
        _prefixed("transaction_id", "TXN-"), _prefixed("order_id", "ORD-"),
        F.date_format("transaction_date", "yyyy-MM-dd HH:mm:ss").alias("transaction_date"),
        _prefixed("store_id", "STR-"), _prefixed("customer_id", "CUST-"), _prefixed("product_id", "PRD-"),
        "quantity", F.col("unit_price").cast("double").alias("unit_price"),
        F.col("discount_pct").cast("double").alias("discount_pct"), "payment_method", "channel",
        y.alias("_year"))
     .write.partitionBy("_year").option("header", "true").option("compression", "gzip").csv(f"{root}/sales"))
    c = customers(spark, sf_dir)
    c.select(_prefixed("customer_id", "CUST-"), *[x for x in c.columns if x != "customer_id"]) \
        .write.option("header", "true").csv(f"{root}/customers")
    p = products(spark, sf_dir)
    p.select(_prefixed("product_id", "PRD-"),
             *[F.col(x).cast("double").alias(x) if x in ("unit_cost", "unit_price") else F.col(x)
               for x in p.columns if x != "product_id"]) \
        .write.option("header", "true").csv(f"{root}/products")
    st = stores(spark, sf_dir)
    st.select(_prefixed("store_id", "STR-"), *[x for x in st.columns if x != "store_id"]) \
        .write.option("header", "true").csv(f"{root}/stores")
    inv = inventory(spark, sf_dir)
    inv.select("inventory_id", _prefixed("store_id", "STR-"), _prefixed("product_id", "PRD-"),
               *[x for x in inv.columns if x not in ("inventory_id", "store_id", "product_id")]) \
        .write.option("header", "true").csv(f"{root}/inventory")
