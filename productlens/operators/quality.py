"""Declared-constraint checks as jobs (Q1-Q3).

Spark does not enforce primary keys, NOT NULL or foreign keys, so each
declared constraint becomes an aggregation that counts its violations. All
key checks run as one union + partial-aggregated ``groupBy`` and all
reference checks as one anti join; the results are a handful of rows (the
per-check summaries are bounded by the number of checks and broadcast).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from productlens import schemas
from productlens.functions.columns import literal_frame


def _names(tables: dict[str, DataFrame], rows, ddl: str) -> DataFrame:
    """The fixed list of checks as a tiny frame (so a check on an empty table still reports 0)."""
    spark = next(iter(tables.values())).sparkSession
    return literal_frame(spark, list(rows), ddl)


def pk_violations(tables: dict[str, DataFrame], keys: dict[str, str] = schemas.PRIMARY_KEYS) -> DataFrame:
    """Q1: per table, rows, distinct keys, keys occurring more than once and NULL keys.

    All tables' keys are unioned into one (table, key) column pair and counted
    in one ``groupBy`` (NULL keys form their own group, partial aggregation
    map-side), then summarised per table.
    """
    parts = [tables[t].select(F.lit(t).alias("table_name"), F.col(k).cast("string").alias("_k"))
             for t, k in keys.items()]
    per_key = reduce(DataFrame.unionByName, parts).groupBy("table_name", "_k").agg(F.count(F.lit(1)).alias("_n"))
    present, dup = F.col("_k").isNotNull(), F.col("_k").isNotNull() & (F.col("_n") > 1)
    summary = per_key.groupBy("table_name").agg(
        F.sum("_n").alias("rows"),
        F.count_if(present).alias("distinct_keys"),
        F.count_if(dup).alias("duplicate_keys"),
        F.sum(F.when(dup, F.col("_n"))).alias("rows_with_duplicate_key"),
        F.sum(F.when(~present, F.col("_n"))).alias("null_keys"))
    names = _names(tables, keys.items(), "table_name string, key_column string")
    zero = F.lit(0).cast("bigint")
    return names.join(F.broadcast(summary), "table_name", "left").select(
        "table_name", "key_column",
        *[F.coalesce(F.col(c), zero).alias(c) for c in
          ("rows", "distinct_keys", "duplicate_keys", "rows_with_duplicate_key", "null_keys")])


def null_violations(tables: dict[str, DataFrame], required=schemas.REQUIRED_COLUMNS) -> DataFrame:
    """Q2: NULLs in NOT NULL columns."""
    parts = [tables[t].agg(F.count_if(F.col(c).isNull()).alias("null_rows"))
             .select(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), "null_rows")
             for t, c in required]
    return reduce(DataFrame.unionByName, parts)


def orphan_keys(tables: dict[str, DataFrame], fks=schemas.FOREIGN_KEYS,
                extra=(("raw_events", "user_id", "dim_users", "user_id"),)) -> DataFrame:
    """Q3: non-NULL foreign-key values with no parent row (rows and distinct values).

    ``extra`` adds undeclared references worth watching (events of unknown
    users). Child keys are first reduced to distinct values with row counts
    (partial aggregation, so a hot key is one row per map task), then every
    reference is checked by one ``left_anti`` join of those keys against the
    unioned parent keys on (parent, key).
    """
    checks = tuple(fks) + tuple(extra)
    children = reduce(DataFrame.unionByName, [
        tables[child].select(F.lit(child).alias("table_name"), F.lit(ccol).alias("column_name"),
                             F.lit(parent).alias("ref_table"), F.col(ccol).cast("string").alias("_k"))
        .filter(F.col("_k").isNotNull())
        for child, ccol, parent, _ in checks])
    parents = reduce(DataFrame.unionByName, [
        tables[parent].select(F.lit(parent).alias("ref_table"), F.col(pcol).cast("string").alias("_k"))
        for parent, pcol in dict.fromkeys((p, pc) for _, _, p, pc in checks)])
    keys = children.groupBy("table_name", "column_name", "ref_table", "_k").agg(F.count(F.lit(1)).alias("_n"))
    orphans = keys.join(parents, ["ref_table", "_k"], "left_anti")
    counts = orphans.groupBy("table_name", "column_name", "ref_table").agg(
        F.sum("_n").alias("orphan_rows"), F.count(F.lit(1)).alias("orphan_keys"))
    names = _names(tables, [(c, cc, p) for c, cc, p, _ in checks],
                   "table_name string, column_name string, ref_table string")
    zero = F.lit(0).cast("bigint")
    return names.join(F.broadcast(counts), ["table_name", "column_name", "ref_table"], "left").select(
        "table_name", "column_name", "ref_table",
        F.coalesce(F.col("orphan_rows"), zero).alias("orphan_rows"),
        F.coalesce(F.col("orphan_keys"), zero).alias("orphan_keys"))


# Grain (unique key) of each derived table.
DERIVED_GRAINS = {
    "fct_events": ("event_id",),
    "fct_sessions": ("user_id", "session_number"),
    "dim_user_cohorts": ("user_id",),
    "fct_feature_adoption": ("user_id",),
    "mart_cohort_retention_weekly": ("signup_week", "adopted_feature", "week_number"),
    "mart_user_revenue_monthly": ("user_id", "revenue_month"),
    "mart_feature_impact_summary": ("revenue_month", "adopted_feature", "feature_rollout_eligible", "industry",
                                    "company_size", "acquisition_channel"),
    "mart_revenue_relative_to_adoption": ("user_id", "revenue_month"),
    "mart_user_baseline_engagement": ("user_id",),
    "mart_user_engagement_tiers": ("user_id",),
    "mart_user_week_retention": ("user_id", "week_number"),
}


def grain_violations(tables: dict[str, DataFrame], grains=DERIVED_GRAINS) -> DataFrame:
    """Q1 for derived tables: rows, distinct grain keys and keys occurring more than once.

    Each table is grouped by its own typed key columns (partially aggregated)
    and summed to one row; the rows are unioned. A NULL key part is a value
    of the grain here (a never-invoiced user has one NULL month).
    """
    zero = F.lit(0).cast("bigint")
    parts = []
    for t, keys in grains.items():
        per_key = tables[t].groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(per_key.agg(
            F.coalesce(F.sum("_n"), zero).alias("rows"), F.count(F.lit(1)).alias("distinct_keys"),
            F.count_if(F.col("_n") > 1).alias("duplicate_keys"))
            .select(F.lit(t).alias("table_name"), F.lit(",".join(keys)).alias("grain"), "rows", "distinct_keys",
                    "duplicate_keys"))
    return reduce(DataFrame.unionByName, parts)
