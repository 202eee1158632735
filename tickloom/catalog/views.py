"""The test tables in the shapes the operators work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import wide_key
from tickloom.operators.series import AT, in_blocks, in_order
from tickloom.sinks.kafka import encode_json
from tickloom.workspace import settle

# Orders the ticks of a ticker and day.
TICK_ORDER = {"order_by": ("sequence",), "unique_order": True}

TOPIC = "user_events"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales as market ticks: brand is the ticker, prices are in cents.

    Prices in whole cents keep sums of them exact, in whatever order they are added. All
    ticks of a day share their timestamp; ``sequence`` orders them by order, line, part
    and price, so that ticks with the same sequence have the same price.
    """
    price = F.rint(F.col("l_extendedprice") * 100)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    sales = table(spark, sf_dir, "lineitem")
    return sales.join(part, sales.l_partkey == part.p_partkey).select(
        F.col("p_brand").alias("ticker"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_shipdate").cast("date").alias("date"),
        price.alias("open"),
        (price * (1 + F.col("l_tax"))).alias("high"),
        (price * (1 - F.col("l_discount"))).alias("low"),
        price.alias("close"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        wide_key(
            F.col("l_orderkey") * 10 + F.col("l_linenumber"),
            F.col("l_partkey") * 100_000_000 + price.cast("bigint"),
        ).alias("sequence"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
    )


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as market ticks; a ticker never has two at the same time."""
    price = F.rint(F.col("value") * 100)
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("ticker"),
        F.col("ts").alias("timestamp"),
        F.col("ts").cast("date").alias("date"),
        price.alias("open"),
        price.alias("high"),
        price.alias("low"),
        price.alias("close"),
        F.col("user_id").alias("volume"),
    )


def tick_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ticks as JSON messages; the volume exceeds 32 bits."""
    iso = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    wide = F.col("volume") + 3_000_000_000
    shaped = event_ticks(spark, sf_dir).drop("date")
    return encode_json(shaped.withColumns({"timestamp": iso, "volume": wide}), key="ticker")


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as user events; clicks stay a kind of event nobody knows."""
    kind = F.col("event_type")
    event = (
        F.when(kind == "view", "view_page")
        .when(kind == "signup", "login")
        .when(kind == "error", "logout")
        .otherwise(kind)
    )
    page = F.concat(F.lit("page_"), F.get_json_object("props", "$.k"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id"),
        F.col("user_id").cast("int").alias("user_id"),
        event.alias("event"),
        F.when(kind == "purchase", F.col("value").cast("int")).alias("amount"),
        F.when(kind == "view", page).alias("page"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
    )


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User events as a Kafka source would yield them, four partitions by user."""
    fields = ("user_id", "event", "amount", "page", "timestamp")
    return user_events(spark, sf_dir).select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.to_timestamp("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def ridership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales as ridership rows: return flag is the line, supplier the station."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("SBWY_ROUT_LN_NM"),
        F.col("l_suppkey").cast("string").alias("SBWY_STNS_NM"),
        F.col("l_quantity").cast("bigint").alias("GTON_TNOPE"),
        F.col("l_linenumber").cast("bigint").alias("GTOFF_TNOPE"),
    )


def ridership_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ridership rows the way the service sends them, counters as text."""
    return ridership(spark, sf_dir).withColumns(
        {name: F.col(name).cast("string") for name in ("GTON_TNOPE", "GTOFF_TNOPE")}
    )


def _pieces(sales: DataFrame, by: list[str], most: int) -> DataFrame:
    """Sales with a ``piece`` of their group, ``most`` rows in each and the rest in the last:
    rows are numbered within their group by a sort, none of which comes together."""
    ordered = in_order(sales, by, ["l_orderkey", "l_linenumber", "l_partkey"])
    return in_blocks(ordered, by, most, block="piece").drop(AT, "_number")


def envelopes(
    spark: SparkSession,
    sf_dir: str,
    by: tuple[str, ...] = ("l_orderkey",),
    most: int | None = None,
) -> DataFrame:
    """Answers of the ridership service: the sales of an order, or of what ``by`` names,
    in several answers where they are more than ``most``.

    Answers about finished lines report an error, so their rows must not be used; for
    each nation there is an answer without rows.
    """
    sales = table(spark, sf_dir, "lineitem")
    group = [*by, "l_linestatus"]
    if most is not None:
        sales, group = _pieces(sales, group, most), [*group, "piece"]
    failed = F.col("l_linestatus") == "F"
    row = F.struct(
        F.date_format("l_shipdate", "yyyyMMdd").alias("USE_YMD"),
        F.col("l_returnflag").alias("SBWY_ROUT_LN_NM"),
        F.col("l_suppkey").cast("string").alias("SBWY_STNS_NM"),
        F.col("l_quantity").cast("bigint").cast("string").alias("GTON_TNOPE"),
        F.col("l_linenumber").cast("string").alias("GTOFF_TNOPE"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("REG_YMD"),
    )
    answers = sales.groupBy(*group).agg(F.collect_list(row).alias("row"))
    nobody = table(spark, sf_dir, "nation").select(F.lit("N").alias("l_linestatus"))
    answers = answers.select("l_linestatus", "row").unionByName(
        nobody.withColumn("row", F.array().cast(answers.schema["row"].dataType))
    )
    result = F.struct(
        F.when(failed, "ERROR-500").otherwise("INFO-000").alias("CODE"),
        F.when(failed, "server error").otherwise("ok").alias("MESSAGE"),
    )
    answer = F.struct(F.size("row").alias("list_total_count"), result.alias("RESULT"), "row")
    return answers.select(F.to_json(F.struct(answer.alias("CardSubwayStatsNew"))).alias("value"))


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as people; the balance takes the place of the age."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("age")
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("text").alias("line"))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales as listings with two text columns, three numbers and a price."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_returnflag").alias("neighbourhood_cleansed"),
        F.col("l_linestatus").alias("room_type"),
        F.col("l_quantity").alias("bedrooms"),
        F.col("l_discount").alias("bathrooms"),
        F.col("l_tax").alias("number_of_reviews"),
        F.col("l_extendedprice").alias("price"),
    )


LISTING_KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]
LISTING_FIELDS = [
    "neighbourhood_cleansed",
    "room_type",
    "bedrooms",
    "bathrooms",
    "number_of_reviews",
    "price",
]
