"""The library's input tables, built from the given star-schema tables.

Each binding exists twice: as DataFrame code and as the SQL of the same view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from townpulse.functions.categories import with_types
from townpulse.functions.times import elapsed_days, with_time_parts
from townpulse.sources.readers import spread

#: Partitions for costly row work on the given tables, which are single files.
SPREAD = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer -> nation and region. The nation and region tables have fixed size."""
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return table(spark, sf_dir, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))


def complaints(spark: SparkSession, sf_dir: str, activity: bool = True) -> DataFrame:
    """Cleaned complaints, one per order; without ``activity`` lineitem is not read."""
    df = (
        table(spark, sf_dir, "orders")
        .join(_places(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("ticket_id"),
            F.concat(F.lit("{"), "o_orderpriority", F.lit(","), "c_mktsegment", F.lit("}")).alias("type"),
            F.col("n_name").alias("district"),
            F.col("r_name").alias("province"),
            F.col("o_orderdate").cast("timestamp").alias("timestamp"),
            F.col("o_orderstatus").alias("state"),
            (F.lit(13.5) + F.col("o_custkey") % 997 / F.lit(997.0) * F.lit(0.5)).alias("lat"),
            (F.lit(100.3) + F.col("o_orderkey") % 991 / F.lit(991.0) * F.lit(0.5)).alias("lon"),
        )
    )
    df = with_time_parts(with_types(df))
    if not activity:
        return df
    last = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("ticket_id")).agg(
        F.max("l_shipdate").cast("timestamp").alias("last_activity")
    )
    return df.join(last, "ticket_id", "left").withColumn(
        "solve_days", elapsed_days(F.col("timestamp"), F.col("last_activity"))
    )


COMPLAINTS = """
complaints AS (
  SELECT o_orderkey AS ticket_id, '{' || o_orderpriority || ',' || c_mktsegment || '}' AS type,
         o_orderpriority AS primary_type, n_name AS district, r_name AS province,
         o_orderdate AS timestamp, o_orderstatus AS state,
         13.5::DOUBLE + (o_custkey % 997)::DOUBLE / 997::DOUBLE * 0.5::DOUBLE AS lat,
         100.3::DOUBLE + (o_orderkey % 991)::DOUBLE / 991::DOUBLE * 0.5::DOUBLE AS lon,
         last_activity,
         CAST(floor((epoch_us(last_activity) - epoch_us(o_orderdate)) / 86400000000) AS BIGINT) AS solve_days
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_activity FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
)"""


def complaint_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw complaint records, one per update of a ticket, with the flaws of raw data."""
    k, p, s = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    key, cust = F.col("l_orderkey"), F.col("o_custkey")
    types = F.concat(F.lit("{"), "o_orderpriority", F.lit(" , "), "c_mktsegment", F.lit("}"))
    coords = F.format_string("100.%03d,13.%03d", key % 991, cust % 997)
    return (
        spread(table(spark, sf_dir, "lineitem"), SPREAD)
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_places(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            key.cast("string").alias("ticket_id"),
            F.when(k == 7, "{}").when(k == 6, None).when(k == 5, "ไม่ระบุ").otherwise(types).alias("type"),
            F.when(F.col("l_returnflag") != "R", F.concat(F.lit("ORG "), (s % 10).cast("string"))).alias("organization"),
            F.when(F.col("l_linestatus") == "F", F.concat(F.lit("line "), k.cast("string"))).alias("comment"),
            F.lit(None).cast("string").alias("photo"),
            F.lit(None).cast("string").alias("photo_after"),
            F.when(p % 50 == 0, None).when(p % 50 == 1, "bad").otherwise(coords).alias("coords"),
            F.concat(F.lit("no. "), (cust % 100).cast("string")).alias("address"),
            F.when(s % 20 != 0, F.concat(F.lit("S"), (cust % 5).cast("string"))).alias("subdistrict"),
            F.when(p % 40 != 0, F.col("n_name")).alias("district"),
            F.when(F.col("r_name") == "AFRICA", "กรุงเทพมหานคร").when(F.col("r_name") == "AMERICA", "Bangkok")
            .when(F.col("r_name") == "ASIA", "จังหวัดbangkok").when(F.col("r_name") == "EUROPE", "Nonthaburi").alias("province"),
            F.when(p % 60 == 0, "n/a").otherwise(F.concat(
                F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 08:30:15.123456"),
                F.element_at(F.array(F.lit("+00"), F.lit("+0700"), F.lit("+07:00")), (key % 3 + 1).cast("int")),
            )).alias("timestamp"),
            F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(" 05:00:00.250000+00")).alias("last_activity"),
            F.col("o_orderstatus").alias("state"),
            F.when(F.col("l_quantity") % 6 != 0, F.col("l_quantity") % 6).alias("star"),
            (k - 1).alias("count_reopen"),
            F.struct("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("ord"),
        )
    )


COMPLAINT_LOG = """
complaint_log AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS ticket_id,
         CASE l_linenumber WHEN 7 THEN '{}' WHEN 6 THEN NULL WHEN 5 THEN 'ไม่ระบุ'
              ELSE '{' || o_orderpriority || ' , ' || c_mktsegment || '}' END AS type,
         o_orderpriority,
         CASE WHEN l_returnflag <> 'R' THEN 'ORG ' || (l_suppkey % 10) END AS organization,
         CASE WHEN l_linestatus = 'F' THEN 'line ' || l_linenumber END AS comment,
         CASE l_partkey % 50 WHEN 0 THEN NULL WHEN 1 THEN 'bad'
              ELSE printf('100.%03d,13.%03d', l_orderkey % 991, o_custkey % 997) END AS coords,
         'no. ' || (o_custkey % 100) AS address,
         CASE WHEN l_suppkey % 20 <> 0 THEN 'S' || (o_custkey % 5) END AS subdistrict,
         CASE WHEN l_partkey % 40 <> 0 THEN n_name END AS district,
         CASE r_name WHEN 'AFRICA' THEN 'กรุงเทพมหานคร' WHEN 'AMERICA' THEN 'Bangkok'
              WHEN 'ASIA' THEN 'จังหวัดbangkok' WHEN 'EUROPE' THEN 'Nonthaburi' END AS province,
         CASE WHEN l_partkey % 60 <> 0 THEN o_orderdate + INTERVAL 30615123456 MICROSECONDS
              - CASE WHEN l_orderkey % 3 = 0 THEN INTERVAL 0 HOURS ELSE INTERVAL 7 HOURS END END AS timestamp,
         l_shipdate + INTERVAL 18000250000 MICROSECONDS AS last_activity,
         o_orderstatus AS state,
         CASE WHEN l_quantity % 6 <> 0 THEN l_quantity % 6 END AS star,
         l_linenumber - 1 AS count_reopen,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC,
                            l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS newest
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

_PLACES = ["Soi 5, Sukhumvit Road", "LAT PHRAO 71", "opposite Siam Square", "ถนนพระราม 9", "Moo 4", "Silom Soi 2 and Sathon"]
_NAMES = ["Pathumwan", "วัฒนา", "Unknown", "เขตปทุมวัน", "จตุ", "Atlantis", "", "Bang Kapi"]


def outages(spark: SparkSession, sf_dir: str, how: str = "inner") -> DataFrame:
    """Raw outage events with clock texts, some of them bad or unknown; ``how`` "left" keeps events of no nation."""
    e, u, ts = F.col("event_id"), F.col("user_id"), F.col("ts").cast("timestamp")
    end = F.timestamp_add("SECOND", F.floor(F.col("value") * 60).cast("int"), ts)
    nation = table(spark, sf_dir, "nation").select((F.col("n_nationkey")).alias("_nk"), "n_name")
    return (
        spread(table(spark, sf_dir, "events"), SPREAD)
        .withColumn("_nk", (u % 25).cast("int"))
        .join(F.broadcast(nation), "_nk", how)
        .select(
            e.alias("event_id"),
            F.to_date(ts).alias("date"),
            F.date_format(ts, "EEEE").alias("day_of_week"),
            F.when(e % 37 == 0, "24:00").when(e % 41 == 0, "bad").when(e % 43 == 0, None)
            .otherwise(F.date_format(ts, "HH:mm")).alias("start"),
            F.when(e % 47 == 0, "9:00").otherwise(F.date_format(end, "HH:mm")).alias("end"),
            F.concat(F.lit("Feeder "), (u % 7).cast("string")).alias("name"),
            F.element_at(F.array(*[F.lit(x) for x in _PLACES]), (e % 6 + 1).cast("int")).alias("location"),
            F.when(e % 29 == 0, "Unknown").when(e % 31 == 0, " unknown ").otherwise(F.col("n_name")).alias("district"),
            F.element_at(F.array(*[F.lit(x) for x in _NAMES]), (e % 8 + 1).cast("int")).alias("named_district"),
            F.when(e % 5 == 0, "Nonthaburi").when(e % 3 == 0, "BANGKOK").otherwise("Bangkok").alias("province"),
            (F.lit(25.0) + e % 15 + (u % 2) * F.lit(0.5)).alias("temp"),
            ((u % 20) * F.lit(1.25)).alias("rain"),
            ((e % 60) * F.lit(0.75)).alias("wind_gust"),
        )
    )


OUTAGES = """
outages AS (
  SELECT event_id, CAST(ts AS DATE) AS date, dayname(ts) AS day_of_week,
         CASE WHEN event_id % 37 = 0 THEN '24:00' WHEN event_id % 41 = 0 THEN 'bad' WHEN event_id % 43 = 0 THEN NULL
              ELSE strftime(ts, '%H:%M') END AS "start",
         CASE WHEN event_id % 47 = 0 THEN '9:00'
              ELSE strftime(ts + to_seconds(CAST(floor(value * 60) AS BIGINT)), '%H:%M') END AS "end",
         'Feeder ' || (user_id % 7) AS name,
         (['Soi 5, Sukhumvit Road', 'LAT PHRAO 71', 'opposite Siam Square', 'ถนนพระราม 9', 'Moo 4',
           'Silom Soi 2 and Sathon'])[event_id % 6 + 1] AS location,
         CASE WHEN event_id % 29 = 0 THEN 'Unknown' WHEN event_id % 31 = 0 THEN ' unknown ' ELSE n_name END AS district,
         (['Pathumwan', 'วัฒนา', 'Unknown', 'เขตปทุมวัน', 'จตุ', 'Atlantis', '', 'Bang Kapi'])[event_id % 8 + 1] AS named_district,
         CASE WHEN event_id % 5 = 0 THEN 'Nonthaburi' WHEN event_id % 3 = 0 THEN 'BANGKOK' ELSE 'Bangkok' END AS province,
         25.0::DOUBLE + event_id % 15 + (user_id % 2) * 0.5::DOUBLE AS temp,
         (user_id % 20) * 1.25::DOUBLE AS rain,
         (event_id % 60) * 0.75::DOUBLE AS wind_gust
  FROM events JOIN nation ON user_id % 25 = n_nationkey
)"""


def labelled_outages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outages with valid clock texts, minutes and a given cluster label."""
    from townpulse.plans.outage_clusters import with_minutes

    df = outages(spark, sf_dir).filter(
        F.col("start").rlike(r"^\d\d:\d\d$") & F.col("end").rlike(r"^\d\d:\d\d$")
    )
    return with_minutes(df).withColumn("cluster", (F.col("event_id") % 4).cast("int"))


LABELLED_OUTAGES = OUTAGES + """,
minutes AS (
  SELECT *, CAST(split_part("start", ':', 1) AS INT) * 60 + CAST(split_part("start", ':', 2) AS INT) AS start_min,
         CAST(split_part("end", ':', 1) AS INT) * 60 + CAST(split_part("end", ':', 2) AS INT) AS end_min,
         CAST(event_id % 4 AS INT) AS cluster
  FROM outages WHERE regexp_full_match("start", '[0-9]{2}:[0-9]{2}') AND regexp_full_match("end", '[0-9]{2}:[0-9]{2}')
),
labelled AS (
  SELECT *, end_min - start_min + CASE WHEN end_min < start_min THEN 1440 ELSE 0 END AS duration FROM minutes
)"""


def weather_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather readings with UTC times, derived from the events."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("_nk"), F.col("n_name").alias("district"))
    e, u = F.col("event_id"), F.col("user_id")
    return (
        table(spark, sf_dir, "events").withColumn("_nk", (u % 25).cast("int")).join(F.broadcast(nation), "_nk")
        .select(
            "district", F.col("ts").cast("timestamp").alias("ts"),
            (F.lit(24.0) + e % 11).alias("temp"), ((e % 8) * F.lit(0.25)).alias("rain"),
            ((u % 33) * F.lit(1.5)).alias("wind_gust"),
        )
    )


WEATHER = """
weather_hourly AS (
  SELECT n_name AS district, ts, 24.0::DOUBLE + event_id % 11 AS temp, (event_id % 8) * 0.25::DOUBLE AS rain,
         (user_id % 33) * 1.5::DOUBLE AS wind_gust
  FROM events JOIN nation ON user_id % 25 = n_nationkey
),
weather_daily AS (
  SELECT district, CAST(ts + INTERVAL 7 HOURS AS DATE) AS date, max(temp) AS temp, sum(rain) AS rain,
         max(wind_gust) AS wind_gust FROM weather_hourly GROUP BY 1, 2
)"""

SERIES = """
counts AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1),
spine AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM counts),
daily AS (SELECT date, coalesce(n, 0) AS complaint_count FROM spine LEFT JOIN counts USING (date)),
features AS (
  SELECT date, complaint_count, CAST(isodow(date) - 1 AS INT) AS dayofweek, CAST(month(date) AS INT) AS month,
         CAST(isodow(date) >= 6 AS INT) AS is_weekend,
         avg(complaint_count) OVER (ORDER BY date ROWS 6 PRECEDING) AS roll_mean_7,
         coalesce(stddev_samp(complaint_count) OVER (ORDER BY date ROWS 6 PRECEDING), 0) AS roll_std_7,
         avg(complaint_count) OVER (ORDER BY date ROWS 29 PRECEDING) AS roll_mean_30
  FROM daily
)"""


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bare complaints for volume series: id and day of each order."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ticket_id"), F.col("o_orderdate").cast("timestamp").alias("timestamp")
    )
