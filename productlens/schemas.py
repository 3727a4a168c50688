"""Declared schemas of the base tables (raw layer and core dimensions/facts)."""

from __future__ import annotations

from pyspark.sql import types as T

S, TS, B = T.StringType(), T.TimestampType(), T.BooleanType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


RAW_EVENTS = _schema(
    ("event_id", S, True),
    ("user_id", S, True),
    ("event_name", S, True),
    ("event_time", TS, True),
    ("feature_name", S, True),
    ("session_id", S, True),
    ("device_type", S, True),
    ("country", S, True),
    ("properties_json", S, True),
    ("ingested_at", TS, True),
)

DIM_USERS = _schema(
    ("user_id", S, False),
    ("signup_at", TS, False),
    ("industry", S, True),
    ("company_size", S, True),
    ("country", S, True),
    ("acquisition_channel", S, True),
    ("is_internal", B, True),
)

DIM_PLANS = _schema(
    ("plan_id", S, False),
    ("plan_name", S, True),
    ("monthly_price", T.DecimalType(10, 2), True),
    ("seat_based", B, True),
)

DIM_FEATURES = _schema(
    ("feature_name", S, False),
    ("launched_at", TS, True),
    ("rollout_start_at", TS, True),
    ("rollout_pct_initial", T.DecimalType(5, 2), True),
    ("notes", S, True),
)

FCT_SUBSCRIPTIONS = _schema(
    ("subscription_id", S, False),
    ("user_id", S, True),
    ("plan_id", S, True),
    ("started_at", TS, True),
    ("ended_at", TS, True),
    ("status", S, True),
    ("updated_at", TS, True),
)

FCT_BILLING_INVOICES = _schema(
    ("invoice_id", S, False),
    ("user_id", S, True),
    ("invoice_period_start", TS, True),
    ("invoice_period_end", TS, True),
    ("amount_usd", T.DecimalType(10, 2), True),
    ("issued_at", TS, True),
    ("paid_at", TS, True),
    ("status", S, True),
)

BASE_TABLES = {
    "raw_events": RAW_EVENTS,
    "dim_users": DIM_USERS,
    "dim_plans": DIM_PLANS,
    "dim_features": DIM_FEATURES,
    "fct_subscriptions": FCT_SUBSCRIPTIONS,
    "fct_billing_invoices": FCT_BILLING_INVOICES,
}

# Declared primary keys, foreign keys and required columns (checked by
# operators.quality, since Spark does not enforce them).
PRIMARY_KEYS = {
    "dim_users": "user_id",
    "dim_plans": "plan_id",
    "dim_features": "feature_name",
    "fct_subscriptions": "subscription_id",
    "fct_billing_invoices": "invoice_id",
}
FOREIGN_KEYS = (
    ("fct_subscriptions", "user_id", "dim_users", "user_id"),
    ("fct_subscriptions", "plan_id", "dim_plans", "plan_id"),
    ("fct_billing_invoices", "user_id", "dim_users", "user_id"),
)
REQUIRED_COLUMNS = (
    ("dim_users", "signup_at"),
)

# Columns a loader fills when the source omits them (a default applies only to
# an omitted column; an explicit NULL stays NULL).
LOAD_DEFAULTS = {
    "raw_events": {"ingested_at": "load_ts"},
    "fct_subscriptions": {"updated_at": "load_ts"},
    "dim_users": {"is_internal": False},
    "dim_plans": {"seat_based": False},
}
