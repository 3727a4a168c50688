"""Derive the pipeline's base tables from the driver's parquet tables.

The driver tables (``events``, ``customer``, ``orders``) carry no signup
dates, features, sessions or invoices, so they are relabelled by fixed,
deterministic rules (no row of the driver tables is dropped) that also inject the data-quality faults the cleaning
jobs exist for (missing event times, malformed client times and payloads, duplicate and
NULL event ids, unknown users, invalid devices/countries, internal users,
NULL invoice periods). Every rule is plain column arithmetic, so the
relabelling is a narrow, shuffle-free projection that scales with the input.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from productlens import config, schemas
from productlens.functions.columns import MICROS_PER_DAY, literal_frame

# --- fixed values of the relabelling rules ---
BASE_DATE = date(2024, 1, 1)          # day 0 of the driver's event log
SIGNUP_SPREAD_DAYS = 21               # signup_at = BASE_DATE + custkey % 21 days
COMPANY_SIZES = ("1-10", "11-50", "51-200", "201-1000", "1000+")
CHANNELS = ("organic", "paid_search", "sales", "partner", "referral")
PLANS = (                             # plan_id, plan_name, monthly_price, seat_based
    ("free", "Free", "0.00", False),
    ("starter", "Starter", "19.00", False),
    ("pro", "Pro", "49.00", False),
    ("business", "Business", "99.00", True),
)
FEATURE_ROLLOUT_START = datetime(2024, 1, 8)
DRIVER_ROLLOUT_DAYS = 14              # rollout length used with the 30-day driver log
INVOICE_BASE_MONTH = date(2023, 8, 1)
ORDER_STATUS = (("F", "paid"), ("O", "open"), ("P", "void"))
INVALID_DEVICE = "unkn0wn"
INVALID_COUNTRY = "XX"
OTHER_FEATURE = "quick_search"        # a second feature, without a rollout
# --- end of fixed values ---

HOUR_US = 3_600_000_000
BASE_DAY = (BASE_DATE - date(1970, 1, 1)).days
BASE_US = BASE_DAY * MICROS_PER_DAY


def _idiv(c: Column, n: int) -> Column:
    """Exact floor division of a non-negative bigint (< 2**53) by n."""
    return ((c - F.pmod(c, F.lit(n))) / F.lit(n)).cast("bigint")


def _pick(idx: Column, values) -> Column:
    """values[idx] for a 0-based index; NULL past the end."""
    expr = None
    for i, v in enumerate(values):
        expr = F.when(idx == i, F.lit(v)) if expr is None else expr.when(idx == i, F.lit(v))
    return expr


def _user_country(idx9: Column) -> Column:
    # Eight codes plus NULL for the ninth residue.
    return _pick(idx9, config.COUNTRY_CODES)


def dim_users(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    signup_us = F.lit(BASE_US) + (k % SIGNUP_SPREAD_DAYS) * F.lit(MICROS_PER_DAY)
    return customer.select(
        F.concat(F.lit("u_"), k.cast("string")).alias("user_id"),
        F.timestamp_micros(signup_us).alias("signup_at"),
        F.col("c_mktsegment").alias("industry"),
        _pick(k % 5, COMPANY_SIZES).alias("company_size"),
        _user_country(F.col("c_nationkey") % 9).alias("country"),
        _pick((k + F.col("c_nationkey")) % 5, CHANNELS).alias("acquisition_channel"),
        F.when(k % 167 == 0, F.lit(True)).when(k % 61 == 7, F.lit(None)).otherwise(F.lit(False))
        .cast("boolean").alias("is_internal"),
    )


def raw_events(events: DataFrame, feature: str = config.FEATURE) -> DataFrame:
    """Relabel the driver's event log as the raw product-event feed."""
    eid, uid = F.col("event_id"), F.col("user_id")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    e = events.select(
        eid.alias("eid"), uid.alias("uid"), F.col("event_type"), us.alias("us"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    e = e.withColumn("day_us", F.col("us") - F.pmod(F.col("us"), F.lit(MICROS_PER_DAY))).withColumn(
        "di", _idiv(F.col("day_us"), MICROS_PER_DAY) - F.lit(BASE_DAY))
    # Every driver event is kept. Each driver user's days are spread over ten
    # customers (the driver has ten customers per event user), so activity is
    # intermittent per user and retention is not trivially complete.
    u, di = F.col("uid"), F.col("di")
    e = e.withColumn("uid", u * 10 + (u * 31 + di * 17) % 10)
    # The customers with last digit 3 come back over three times as long a span,
    # so some cohorts are seen for more than nine weeks.
    later_us = F.when(F.col("uid") % 10 == 3, di * F.lit(2 * MICROS_PER_DAY)).otherwise(F.lit(0))
    e = e.withColumn("later_us", later_us).withColumn("day_us", F.col("day_us") + F.col("later_us")).withColumn(
        "us", F.col("us") + F.col("later_us"))
    # Time compression: a day's events are squeezed into its first three hours.
    t8 = F.col("day_us") + _idiv(F.col("us") - F.col("day_us"), 8)
    e = e.withColumn("t8", t8)
    # Duplicate feed: ids % 97 arrive twice (later ingestion); ids % 194 tie on ingestion.
    copies = F.sequence(F.lit(0), F.when(F.col("eid") % 97 == 0, F.lit(1)).otherwise(F.lit(0)))
    e = e.withColumn("cp", F.explode(copies))
    tie = F.col("eid") % 194 == 0
    later = (F.col("cp") == 1) & ~tie

    u, di = F.col("uid"), F.col("di")
    k, et = F.col("k"), F.col("event_type")
    name = (
        F.when(et == "signup", "login").when(et == "view", "page_view")
        .when(et == "click", config.VIEWED).when(et == "error", config.EXPOSED)
        .when(et == "purchase",
              F.when(k >= 80, config.USED).when(k < 10, "message_sent")
              .when(k < 20, "file_uploaded").otherwise("project_created"))
    )
    t8_ts = F.timestamp_micros(F.col("t8"))
    base_json = F.concat(F.lit('{"k":'), k.cast("string"), F.lit(',"screen":"app"'))
    client = F.date_format(t8_ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    props = (
        F.when((F.col("eid") % 581 == 0) | (F.col("eid") % 601 == 0), base_json)  # cut off: no JSON
        .when(F.col("eid") % 166 == 0, F.concat(base_json, F.lit("}")))
        .when(F.col("eid") % 249 == 0, F.concat(base_json, F.lit(',"client_event_time":"n/a"}')))
        .when(F.col("eid") % 415 == 0, F.concat(base_json, F.lit(',"client_event_time":null}')))
        .otherwise(F.concat(base_json, F.lit(',"client_event_time":"'), client, F.lit('"}')))
    )
    device = (
        F.when(k % 10 < 4, "desktop").when(k % 10 < 7, "mobile").when(k % 10 == 7, "tablet")
        .when(k % 10 == 8, INVALID_DEVICE)
    )
    session = F.concat(
        F.lit("ses_"), u.cast("string"), F.lit("_"), di.cast("string"),
        F.when(F.col("eid") % 20 == 0, F.lit("_x")).otherwise(F.lit("")),
        F.when((F.col("cp") == 1) & tie, F.lit("_dup")).otherwise(F.lit("")),
    )
    ingested_us = F.col("t8") + F.lit(MICROS_PER_DAY) + F.when(later, F.lit(HOUR_US)).otherwise(F.lit(0))
    e = e.withColumn("name", name)
    return e.select(
        F.when(F.col("eid") % 503 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("e_"), F.col("eid").cast("string"))).alias("event_id"),
        F.when(F.col("eid") % 389 == 0, F.concat(F.lit("u_x"), u.cast("string")))
        .otherwise(F.concat(F.lit("u_"), u.cast("string"))).alias("user_id"),
        F.col("name").alias("event_name"),
        F.when(F.col("eid") % 83 == 0, F.lit(None).cast("timestamp")).otherwise(t8_ts).alias("event_time"),
        F.when(F.col("name").isin(config.EXPOSED, config.VIEWED, config.USED),
               F.when(F.col("eid") % 11 == 5, F.lit(OTHER_FEATURE)).otherwise(F.lit(feature)))
        .alias("feature_name"),
        session.alias("session_id"),
        device.alias("device_type"),
        F.when(k % 50 == 0, F.lit(INVALID_COUNTRY)).otherwise(_user_country(u % 9)).alias("country"),
        props.alias("properties_json"),
        # some events have no time at all: neither event, client nor ingestion time
        F.when(F.col("eid") % 498 != 0, F.timestamp_micros(ingested_us)).alias("ingested_at"),
    )


def dim_features(spark: SparkSession, feature: str = config.FEATURE,
                 rollout_start: datetime = FEATURE_ROLLOUT_START) -> DataFrame:
    start = rollout_start.strftime("%Y-%m-%d %H:%M:%S")
    rows = [(feature, start, start, "20.00", "Rolled out gradually over the rollout window"),
            (OTHER_FEATURE, start, None, None, "Launched without a rollout")]
    return literal_frame(spark, rows, schemas.DIM_FEATURES)


def dim_plans(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, PLANS, schemas.DIM_PLANS)


def billing_invoices(orders: DataFrame) -> DataFrame:
    okey = F.col("o_orderkey")
    start = F.when(okey % 997 == 0, F.lit(None).cast("date")).otherwise(
        F.add_months(F.lit(INVOICE_BASE_MONTH), (okey % 11).cast("int")))
    status = None
    for code, label in ORDER_STATUS:
        cond = F.col("o_orderstatus") == code
        status = F.when(cond, F.lit(label)) if status is None else status.when(cond, F.lit(label))
    o = orders.select(okey, "o_custkey", "o_totalprice", start.alias("start"), status.alias("status"))
    start_ts = F.col("start").cast("timestamp")
    return o.select(
        F.concat(F.lit("inv_"), okey.cast("string")).alias("invoice_id"),
        F.concat(F.lit("u_"), F.col("o_custkey").cast("string")).alias("user_id"),
        start_ts.alias("invoice_period_start"),
        F.add_months(F.col("start"), 1).cast("timestamp").alias("invoice_period_end"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("amount_usd"),
        start_ts.alias("issued_at"),
        F.when(F.col("status") == "paid", F.date_add(F.col("start"), 2).cast("timestamp")).alias("paid_at"),
        F.col("status"),
    )


def subscriptions(customer: DataFrame) -> DataFrame:
    """One subscription per customer; canceled when the account balance is negative."""
    k = F.col("c_custkey")
    start_us = F.lit(BASE_US) + (k % SIGNUP_SPREAD_DAYS) * F.lit(MICROS_PER_DAY)
    canceled = F.col("c_acctbal") < 0
    return customer.select(
        F.concat(F.lit("s_u_"), k.cast("string"), F.lit("_1")).alias("subscription_id"),
        F.concat(F.lit("u_"), k.cast("string")).alias("user_id"),
        _pick(k % 4, [p[0] for p in PLANS]).alias("plan_id"),
        F.timestamp_micros(start_us).alias("started_at"),
        F.when(canceled, F.timestamp_micros(start_us + F.lit(30 * MICROS_PER_DAY))).alias("ended_at"),
        F.when(canceled, F.lit("canceled")).otherwise(F.lit("active")).alias("status"),
        F.timestamp_micros(start_us).alias("updated_at"),
    )


class DriverSource:
    """Base tables derived lazily from a driver scale-factor directory.

    ``tables()`` returns a mapping that builds each base table on first use,
    so a query only plans the relabelling of the tables it reads.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, feature: str = config.FEATURE):
        self.spark, self.sf_dir, self.feature = spark, sf_dir.rstrip("/"), feature
        self.rollout_days = DRIVER_ROLLOUT_DAYS

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def tables(self) -> "LazyTables":
        builders = {
            "raw_events": lambda: raw_events(self._read("events"), self.feature),
            "dim_users": lambda: dim_users(self._read("customer")),
            "dim_plans": lambda: dim_plans(self.spark),
            "dim_features": lambda: dim_features(self.spark, self.feature),
            "fct_subscriptions": lambda: subscriptions(self._read("customer")),
            "fct_billing_invoices": lambda: billing_invoices(self._read("orders")),
        }
        return LazyTables(builders)


class LazyTables(dict):
    """dict of DataFrames whose values are built on first access."""

    def __init__(self, builders):
        super().__init__()
        self._builders = builders

    def __missing__(self, key):
        df = self._builders[key]()
        self[key] = df
        return df

    def keys(self):
        return self._builders.keys()

    def __iter__(self):
        return iter(self._builders)

    def __contains__(self, key):
        return key in self._builders
