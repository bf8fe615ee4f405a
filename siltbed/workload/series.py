"""Daily bars, gap filling, moving features, running products, validity intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.operators.intervals import explode_daily, validity_intervals
from siltbed.operators.timeseries import (
    daily_bars,
    forward_fill,
    moving_averages,
    percent_change,
    range_sliced,
    running_product,
    technical_features,
)
from siltbed.plans.silver import clean_bars, clean_prices
from siltbed.workload.registry import query, rounded, table

BARS_SQL = """
bars AS (
  SELECT event_type, CAST(ts AS DATE) AS date,
         first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
         last(value ORDER BY ts, event_id) AS close, count(*) AS volume
  FROM events GROUP BY ALL)"""

# No trading at the weekend: closes and volumes of Saturday and Sunday are zero.
TRADED_SQL = f"""{BARS_SQL},
traded AS (
  SELECT event_type, date, open, high, low,
         nullif(CASE WHEN isodow(date) > 5 THEN 0 ELSE close END, 0) AS close,
         nullif(CASE WHEN isodow(date) > 5 THEN 0 ELSE volume END, 0) AS volume
  FROM bars),
filled AS (
  SELECT event_type, date, open, high, low,
         last_value(close IGNORE NULLS) OVER w AS close,
         last_value(volume IGNORE NULLS) OVER w AS volume
  FROM traded
  WINDOW w AS (PARTITION BY event_type ORDER BY date
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
featured AS (
  SELECT *, CASE WHEN open <> 0 THEN (close - open) / open END AS daily_return,
         CASE WHEN close <> 0 THEN (high - low) / close END AS volatility_range,
         avg(close) OVER (PARTITION BY event_type ORDER BY date
                          ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS ma_5,
         avg(close) OVER (PARTITION BY event_type ORDER BY date
                          ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS ma_20
  FROM filled)"""

FEATURES = ["daily_return", "volatility_range", "ma_5", "ma_20"]


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return daily_bars(events, "event_type", "ts", "value", ["event_id"])


def traded_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    weekend = F.weekday("date") >= 5
    return bars(spark, sf_dir).withColumns(
        {
            "close": F.when(weekend, 0.0).otherwise(F.col("close")),
            "volume": F.when(weekend, 0).otherwise(F.col("volume")),
        }
    )


@query(f"WITH {BARS_SQL} SELECT * FROM bars")
def ohlcv_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(spark, sf_dir)


@query(f"""WITH {TRADED_SQL}
SELECT event_type, date, open, high, low, close, volume,
       round(daily_return, 6) + 0.0 AS daily_return,
       round(volatility_range, 6) + 0.0 AS volatility_range,
       round(ma_5, 6) + 0.0 AS ma_5, round(ma_20, 6) + 0.0 AS ma_20
FROM featured""")
def ohlcv_technical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship. Bars are one row per key and day, so one window per key is bounded."""
    featured = technical_features(traded_bars(spark, sf_dir), ["event_type"], ["date"])
    return rounded(featured, FEATURES)


@query(f"""WITH {TRADED_SQL}
SELECT date, event_type AS ticker, open, high, low, close, volume, open AS adj_close,
       round(daily_return, 6) + 0.0 AS daily_return,
       round(volatility_range, 6) + 0.0 AS volatility_range,
       round(ma_5, 6) + 0.0 AS ma_5, round(ma_20, 6) + 0.0 AS ma_20
FROM featured""")
def silver_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole bar recipe: text dates with a zone, duplicates, missing keys and dates."""
    landed = traded_bars(spark, sf_dir).select(
        F.concat(F.col("date").cast("string"), F.lit(" 00:00:00-05:00")).alias("Date"),
        F.col("event_type").alias("Ticker"),
        F.col("open").alias("Open"),
        F.col("high").alias("High"),
        F.col("low").alias("Low"),
        F.col("close").alias("Close"),
        F.col("open").alias("Adj Close"),
        F.col("volume").alias("Volume"),
    )
    dirty = (
        landed.unionByName(landed)
        .unionByName(landed.withColumn("Ticker", F.lit(None).cast("string")))
        .unionByName(landed.withColumn("Date", F.lit("not a date")))
    )
    return rounded(clean_bars(dirty), FEATURES)


TICKS_SQL = """
ticks AS (
  SELECT event_type, ts, event_id, CASE WHEN value >= 5 THEN value END AS value FROM events),
filled AS (
  SELECT event_type, ts, event_id, last_value(value IGNORE NULLS) OVER (
           PARTITION BY event_type ORDER BY ts, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
  FROM ticks)"""


def _ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_type", "ts", "event_id", F.when(F.col("value") >= 5, F.col("value")).alias("value")
    )


@query(f"""WITH {TICKS_SQL} SELECT * FROM filled""")
def forward_fill_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events: few keys, each with a large part of all rows, filled hour by hour."""
    return forward_fill(
        _ticks(spark, sf_dir),
        ["event_type"],
        ["ts", "event_id"],
        ["value"],
        slice_by=F.date_trunc("hour", "ts"),
    )


@query(f"""WITH {TICKS_SQL}
SELECT event_type, ts, event_id, value,
       round(avg(value) OVER (PARTITION BY event_type ORDER BY ts, event_id
             ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) + 0.0 AS ma_5,
       round(avg(value) OVER (PARTITION BY event_type ORDER BY ts, event_id
             ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 6) + 0.0 AS ma_20
FROM ticks""")
def moving_average_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events again, in slices of even size whatever the keys."""
    order = ["ts", "event_id"]
    sliced = range_sliced(_ticks(spark, sf_dir), ["event_type"], order)
    averaged = moving_averages(
        sliced, ["event_type"], order, "value", {"ma_5": 5, "ma_20": 20}, F.col("range_slice")
    )
    return rounded(averaged, ["ma_5", "ma_20"]).drop("range_slice")


PATH_SQL = f"""WITH {BARS_SQL}, paths AS (
  SELECT event_type, date, 100.0 * product(1 + (close - open) / (10 * (high + low))) OVER (
           PARTITION BY event_type ORDER BY date
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price
  FROM bars)
SELECT event_type, date, round(greatest(50.0, least(180.0, price)), 6) + 0.0 AS price,
       format('{{:.2f}}', round(greatest(50.0, least(180.0, price)), 6)) AS price_text
FROM paths"""


@query(PATH_SQL)
def running_product_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compounded daily returns from 100, kept between half and 1.8 times the start."""
    rate = (F.col("close") - F.col("open")) / (10 * (F.col("high") + F.col("low")))
    rates = bars(spark, sf_dir).select("event_type", "date", rate.alias("rate"))
    path = running_product(rates, ["event_type"], ["date"], "rate", F.lit(100.0), "price")
    return (
        rounded(path, ["price"])
        .withColumn("price_text", F.format_string("%.2f", "price"))
        .drop("rate")
    )


@query("""
SELECT event_type, ts, event_id,
       round(greatest(50.0, least(180.0, 100.0 * product(1 + (value - 50) / 5000) OVER (
         PARTITION BY event_type ORDER BY ts, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))), 6) + 0.0 AS price
FROM events""")
def running_product_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = table(spark, sf_dir, "events").select(
        "event_type", "ts", "event_id", ((F.col("value") - 50) / 5000).alias("rate")
    )
    path = running_product(
        rates,
        ["event_type"],
        ["ts", "event_id"],
        "rate",
        F.lit(100.0),
        "price",
        slice_by=F.date_trunc("hour", "ts"),
    )
    return rounded(path, ["price"]).drop("rate")


@query("""
WITH yearly AS (
  SELECT o_orderpriority, year(o_orderdate)::INT AS year,
         CASE WHEN sum(o_totalprice) > 0 AND year(o_orderdate) <> 1998 THEN sum(o_totalprice) END AS total
  FROM orders GROUP BY o_orderpriority, year(o_orderdate)),
filled AS (
  SELECT *, last_value(total IGNORE NULLS) OVER (PARTITION BY o_orderpriority ORDER BY year
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f FROM yearly),
prior AS (SELECT *, lag(f) OVER (PARTITION BY o_orderpriority ORDER BY year) AS b FROM filled)
SELECT o_orderpriority, year, round(total, 2) + 0.0 AS total,
       round(coalesce(CASE WHEN b <> 0 THEN (f - b) / b END, 0.0), 6) + 0.0 AS change
FROM prior""")
def percent_change_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year-on-year change of totals with one missing year carried forward."""
    yearly = (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderpriority", F.year("o_orderdate").alias("year"))
        .agg(F.sum("o_totalprice").alias("total"))
        .withColumn("total", F.when((F.col("total") > 0) & (F.col("year") != 1998), F.col("total")))
    )
    changed = percent_change(yearly, ["o_orderpriority"], ["year"], "total", "change")
    return rounded(rounded(changed, ["total"], 2), ["change"])


# Observations: priority x status as the product, the order's price on its date.
INTERVALS_SQL = """
observations AS (
  SELECT o_orderpriority AS product, o_orderstatus AS category,
         CAST(o_orderdate AS DATE) AS report_date, max(o_totalprice) AS price
  FROM orders GROUP BY ALL),
intervals AS (
  SELECT *, report_date AS effective_date,
         CAST(lead(report_date) OVER (PARTITION BY product, category ORDER BY report_date)
              - INTERVAL 1 DAY AS DATE) AS expiration_date
  FROM observations),
daily AS (
  SELECT i.*, CAST(unnest(generate_series(
           CAST(effective_date AS TIMESTAMP),
           CAST(coalesce(expiration_date, (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)) AS TIMESTAMP),
           INTERVAL 1 DAY)) AS DATE) AS date
  FROM intervals i)"""


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    observations = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("product"),
        F.col("o_orderstatus").alias("category"),
        F.col("o_orderdate").cast("date").alias("report_date"),
        F.col("o_totalprice").alias("price"),
    )
    return validity_intervals(observations, ["product", "category"], "report_date", "price")


@query(f"WITH {INTERVALS_SQL} SELECT * FROM intervals")
def scd2_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals(spark, sf_dir)


@query(f"WITH {INTERVALS_SQL} SELECT * FROM daily")
def scd2_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    last_day = table(spark, sf_dir, "orders").agg(F.max(F.col("o_orderdate").cast("date"))).scalar()
    return explode_daily(intervals(spark, sf_dir), last_day=last_day)


PRICES_SQL = """
WITH raw AS (
  SELECT CAST(o_orderdate AS DATE) AS report_date,
         lower(o_orderpriority) AS product,
         CASE WHEN o_orderstatus = 'P' AND o_totalprice < 50000 THEN NULL
              ELSE CAST(o_totalprice AS FLOAT) END AS price,
         CASE o_orderstatus WHEN 'F' THEN 'Gb' WHEN 'O' THEN 'USD' END AS unit,
         CASE o_orderstatus WHEN 'F' THEN 'spot price' WHEN 'O' THEN 'contract price'
              ELSE 'street price' END AS category
  FROM orders),
per_day AS (
  SELECT report_date, product, max(price) AS price, category, unit
  FROM raw GROUP BY report_date, product, category, unit),
intervals AS (
  SELECT *, report_date AS price_effective_date,
         CAST(lead(report_date) OVER (PARTITION BY product, category ORDER BY report_date)
              - INTERVAL 1 DAY AS DATE) AS price_expiration_date
  FROM per_day)
SELECT report_date, product, CAST(price AS DOUBLE) AS price, unit, category,
       price_effective_date, price_expiration_date,
       CAST(unnest(generate_series(
         CAST(price_effective_date AS TIMESTAMP),
         CAST(coalesce(price_expiration_date, (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)) AS TIMESTAMP),
         INTERVAL 1 DAY)) AS DATE) AS date
FROM intervals WHERE price IS NOT NULL"""


@query(PRICES_SQL)
def silver_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole price recipe over messy text columns."""
    status = F.col("o_orderstatus")
    raw = table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Date"),
        F.concat(F.lit("  "), F.regexp_replace("o_orderpriority", " ", " \t "), F.lit("\n")).alias("Product"),
        F.when((status == "P") & (F.col("o_totalprice") < 50000), "n/a")
        .otherwise(F.concat(F.lit("US$ "), F.col("o_totalprice").cast("decimal(12,2)").cast("string")))
        .alias("Price"),
        F.when(status == "F", " GBit ").when(status == "O", "US$").otherwise(" ").alias("Unit"),
        F.when(status == "F", "Spot  Price")
        .when(status == "O", " Contract Price")
        .otherwise("STREET price")
        .alias("Category"),
    )
    return clean_prices(raw).withColumn("price", F.col("price").cast("double"))
