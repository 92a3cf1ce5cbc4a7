"""A raw feed derived from the ``events`` table: what devices would have sent.

The text of :data:`FEED` runs unchanged on any SQL engine, so expected results can be
worked out elsewhere from the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.session import configure
from skyledger.sources.json_docs import NOT_JSON, with_parsed
from skyledger.sources.payloads import delivered

#: Readings, device names, times and statuses in the shapes devices use, with faults.
FEED = """
select event_id as seq,
  case when event_id % 73 = 0 then concat('fw-', cast(event_id as varchar(20))) end as supplied_id,
  case when event_id % 53 = 0 then ''
       else concat('DRONE-', lpad(cast(user_id as varchar(20)), 3, '0')) end as drone_id,
  case when event_id % 59 = 0 then 'half past nine'
       when event_id % 7 = 0 then cast(1704067200 + (event_id % 1000000) * 60 as varchar(20))
       else cast(ts as varchar(30)) end as timestamp_text,
  case when event_id % 67 = 0 then ' ' when event_id % 61 = 0 then 'ROTOR_SWAPPED'
       when event_type = 'purchase' then 'delivery completed'
       when event_type = 'view' then 'route-adjusted' when event_type = 'click' then 'SENSOR_READING'
       when event_type = 'signup' then 'TAKEOFF' when event_id % 2 = 0 then 'MOTOR_FAULT'
       else 'DELIVERY_FAILED' end as event_type_raw,
  case when event_id % 71 = 0 then 'abc' when event_id % 11 = 0 then ''
       when event_type = 'error' and event_id % 2 = 0 then '500' when event_type = 'error' then '503'
       when event_id % 13 = 0 then '404' else '200' end as status_text,
  value as battery_pct, props, event_id % 101 = 0 as broken, event_id % 5 = 0 as embedded,
  case when event_id % 79 = 0 then 120 else event_id % 181 - 90 end as lat,
  case when event_id % 83 = 0 then -300 else event_id % 361 - 180 end as lon, event_id % 7 as rpm
from {events}
"""

#: Records per delivery, and where re-sent records arrive.
DELIVERY_SIZE = 500
LATER = 1_000_000_000


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A small table comes in one split, and what is derived from it is many times its size. With a number, adaptive
    # execution leaves the tasks as they are.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return spark.sql(FEED, events=events_table(spark, sf_dir).repartition(tasks, "event_id"))


def record_text() -> Column:
    """A feed row as the JSON text of a record; broken rows lack their end.

    Some rows hold their telemetry as the JSON text of an object.
    """
    quote = F.lit('"')

    def member(key: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{key}":"'), value, quote, F.lit(","))

    telemetry = F.concat(
        F.lit('{"batteryPct":'),
        F.col("battery_pct").cast("string"),
        F.lit(',"lat":'),
        F.col("lat"),
        F.lit(',"lon":"'),
        F.col("lon"),
        F.lit('","motor":{"é":"x","rpm":['),
        F.col("rpm"),
        F.lit(",true,null]},"),
        F.substring("props", F.lit(2), F.length("props")),
    )
    as_text = F.concat(quote, F.replace(telemetry, quote, F.lit('\\"')), quote)
    whole = F.concat(
        F.lit("{"),
        F.coalesce(member("eventId", F.col("supplied_id")), F.lit("")),
        member("droneId", F.col("drone_id")),
        member("timestamp", F.col("timestamp_text")),
        member("eventType", F.col("event_type_raw")),
        member("statusCode", F.col("status_text")),
        F.lit('"telemetryData":'),
        F.when(F.col("embedded"), as_text).otherwise(telemetry),
        F.lit("}"),
    )
    return F.when(F.col("broken"), F.left(whole, F.lit(20))).otherwise(whole)


def delivered_rows(rows: DataFrame) -> DataFrame:
    """Feed rows in deliveries of :data:`DELIVERY_SIZE`, with every 97th sent again.

    The even ones come again in the same delivery, the odd ones in a later one.
    """
    number = F.floor(F.col("seq") / DELIVERY_SIZE).cast("bigint")
    first = rows.withColumns({"batch_seq": number, "pos": F.col("seq")})
    again = first.where(F.col("seq") % 97 == 0).withColumns(
        {
            "batch_seq": F.when(F.col("seq") % 2 == 0, F.col("batch_seq")).otherwise(
                F.col("batch_seq") + LATER
            ),
            "pos": F.col("pos") + LATER,
        }
    )
    return first.unionByName(again).withColumn("batch_id", F.concat(F.lit("m"), F.col("batch_seq")))


def feed_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of all deliveries of the feed."""
    rows = delivered_rows(feed(spark, sf_dir)).withColumn("raw_text", record_text())
    rows = with_parsed(rows, "raw_text", NOT_JSON).withColumns(
        {
            "raw_json": F.col("raw_text"),
            "source": F.concat(F.lit("sqs:"), F.col("batch_id"), F.lit("#"), F.col("pos")),
        }
    )
    return delivered(rows, F.col("batch_id"), F.col("batch_seq"), F.lit(""))
