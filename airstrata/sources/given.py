"""The given tables as the two feeds.

``events`` play the live API responses and ``orders`` the historical text
records; customers are the stations and nations the cities. Both feeds cover
their whole table. Faults in the feeds follow from column values, so that plain
SQL can state the same rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airstrata.config import ALERT_LABELS
from airstrata.functions.levels import aqi_category
from airstrata.operators.conform import conform_api, conform_csv
from airstrata.schemas import CSV_COLUMNS
from airstrata.sources.documents import parse_documents, queried_city
from airstrata.sources.history import clean_csv

SPINE = ("1995-01-01", "2024-12-31")
DECIMALS = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A feed table; one that comes in fewer splits than cores is spread out first,
    since building and parsing texts is work for the processors."""
    rows, cores = table(spark, sf_dir, name), spark.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def _slug() -> Column:
    return F.lower(F.regexp_replace("n_name", "_", "-"))


def city_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        _slug().alias("city_slug"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("region"),
        F.col("n_nationkey").cast("double").alias("lat"),
        F.col("n_regionkey").cast("double").alias("lon"),
    )


def city_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("source_city"), _slug().alias("conformed_city")
    )


def located(spark: SparkSession, sf_dir: str, rows: DataFrame, customer: str) -> DataFrame:
    people, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return rows.join(people, F.col(customer) == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )


def api_bodies(spark: SparkSession, sf_dir: str, on_the_hour: bool = True) -> DataFrame:
    """Each event as the body of a response, next to the columns of the event."""
    events = located(spark, sf_dir, feed(spark, sf_dir, "events"), "user_id")
    k = F.get_json_object("props", "$.k").cast("double")
    at = F.date_trunc("hour", "ts") if on_the_hour else F.col("ts")

    def reading(value: Column) -> Column:
        return F.struct(value.alias("v"))

    place = F.array(F.col("n_nationkey").cast("double"), F.col("n_regionkey").cast("double"))
    label = F.when(F.col("event_type") == "error", "aqi").otherwise(F.col("event_type"))
    body = F.struct(
        F.col("value").alias("aqi"),
        F.col("user_id").alias("idx"),
        label.alias("dominentpol"),
        F.struct(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso")).alias("time"),
        F.struct(
            F.col("c_name").alias("name"),
            F.concat(F.lit("station/"), F.col("user_id")).alias("url"),
            place.alias("geo"),
        ).alias("city"),
        F.struct(
            reading(k).alias("pm25"),
            reading(F.round(k * 1.6, 5)).alias("pm10"),
            reading(k * 0.5).alias("h"),
            reading(k * 0.25).alias("t"),
        ).alias("iaqi"),
        _slug().alias("_queried_city"),
    )
    return events.select(
        body.alias("data"), "ts", "event_id", "event_type", F.col("value").alias("aqi")
    )


def api_texts(spark: SparkSession, sf_dir: str, on_the_hour: bool = True) -> DataFrame:
    """Each event as the JSON text of a response; 'view' events in the bare shape."""
    wrapped = F.to_json(F.struct(F.lit("ok").alias("status"), "data"))
    text = F.when(F.col("event_type") == "view", F.to_json("data")).otherwise(wrapped)
    return api_bodies(spark, sf_dir, on_the_hour).withColumn("value", text).drop("data")


def api_raw(spark: SparkSession, sf_dir: str, on_the_hour: bool = True) -> DataFrame:
    """Bronze documents with the event time as load time."""
    parsed = parse_documents(api_texts(spark, sf_dir, on_the_hour))
    return parsed.select(
        queried_city().alias("queried_city"), "raw_payload", F.col("ts").alias("ingested_at")
    )


def csv_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a text record, with bad fields for some customers."""
    orders = located(spark, sf_dir, feed(spark, sf_dir, "orders"), "o_custkey")
    priority, balance = F.col("o_orderpriority"), F.col("c_acctbal")
    aqi = F.round(F.col("o_totalprice") / 1000, 5)
    pm25 = F.floor(F.col("o_totalprice") / 5000)
    no_value = priority == "4-NOT SPECIFIED"

    def odd(first: float, text: Column) -> Column:
        """Unusual numbers for the customers in four bands of the balance."""
        bands = [F.lit("NaN"), F.lit("Infinity"), F.lit("1e15"), F.round(F.col("o_totalprice") / 30000, 7).cast("string")]
        for place, band in enumerate(bands):
            low = first + 30 * place
            text = F.when((balance >= low) & (balance < low + 30), band).otherwise(text)
        return text

    fields = {
        "station_id": F.when(balance < -900, "NA").otherwise(F.col("o_custkey").cast("string")),
        "aqi_index": F.when(no_value, "N/A").otherwise(odd(9700, aqi.cast("string"))),
        "location": F.when(balance.between(-900, -700), "Nowhere").otherwise(F.col("n_name")),
        "station_name": F.col("c_name"),
        "url": F.concat(F.lit("station/"), F.col("o_custkey")),
        "dominant_pollutant": F.when(no_value, "null")
        .when(priority == "5-LOW", "aqi")
        .otherwise(priority),
        "pm25": F.when(F.col("o_orderstatus") == "P", "NA").otherwise(
            odd(9850, pm25.cast("string"))
        ),
        "data_time_s": F.when(balance.between(-700, -500), "garbage").otherwise(
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
        ),
        "data_time_tz": F.lit("UTC"),
        "status": F.lit("ok"),
        "alert_level": aqi_category(aqi, ALERT_LABELS),
    }
    blank = F.lit(None).cast("string")
    return orders.select(
        *[fields.get(c, blank).alias(c) for c in CSV_COLUMNS],
        "o_orderkey",
        "o_orderdate",
        "o_orderstatus",
    )


def csv_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze records with the order date as load time."""
    records = csv_records(spark, sf_dir).withColumn("source_file", F.lit(None).cast("string"))
    return clean_csv(records, F.col("o_orderdate"))


def measurements(spark: SparkSession, sf_dir: str, on_the_hour: bool = True) -> DataFrame:
    return conform_api(api_raw(spark, sf_dir, on_the_hour)).unionByName(
        conform_csv(csv_raw(spark, sf_dir), city_map(spark, sf_dir))
    )
