"""Event cleaning: raw product events -> ``fct_events`` (one row per event_id).

Steps: duplicate detection and dedup (earliest ingestion wins), timestamp
repair (event time, else client time from the JSON payload, else ingestion
time), device/country standardisation with out-of-domain flags, and removal
of internal users and events whose user is unknown.

Scale notes
-----------
Nearly all event ids occur once, so dedup does not shuffle the payloads. A
first pass over the ids alone marks hash slots that are seen again
(``repeated_slots``): a two-bit map of ``SLOTS_PER_ROW`` slots a row, built in
blocks, for which every task sends its slots packed into a few rows. Rows in
slots seen once pass straight on; the others, the real duplicates and a few
rows that share a slot by chance, go through the exact ``groupBy(event_id)``,
whose aggregates (``count`` and ``min`` over a struct whose leading fields are
the ordering keys) are combined map-side, so a hot id is collapsed before the
shuffle. The slots are broadcast, so their number is checked: with more than
``MOST_SLOTS`` all rows go through the ``groupBy``, with the same result.
The internal-user filter is a ``left_semi`` join: it never multiplies rows
and Spark/AQE choose broadcast or shuffle from the users table's size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from productlens import config
from productlens.functions.columns import out_of_domain, standardise
from productlens.session import scratch_folder, ship_package

#: slots of the two-bit map for each row: one row in so many shares a slot by chance
SLOTS_PER_ROW = 32
#: slots of a block, which one task holds at a time
BLOCK_BITS = 22
#: slots that a task packs at once
PACKED = 4 << 20
#: most slots that are broadcast (8 bytes each)
MOST_SLOTS = 4 << 20

# Total order used to pick the surviving copy of a duplicated event_id:
# earliest ingestion first, then the payload columns, NULLs last everywhere.
DEDUP_ORDER = ("ingested_at", "event_time", "user_id", "event_name", "feature_name",
               "session_id", "properties_json", "device_type", "country")
PAYLOAD = ("user_id", "event_name", "event_time", "feature_name", "session_id",
           "device_type", "country", "properties_json", "ingested_at")


def _nulls_last_key(columns) -> list[Column]:
    key = []
    for i, c in enumerate(columns):
        key.append(F.col(c).isNull().alias(f"_n{i}"))
        key.append(F.col(c).alias(f"_k{i}"))
    return key


def _packed(batches):
    """A task's distinct slots, one row for each block: offsets in it, and those met more than once."""
    def rows(keys):
        slots, times = np.unique(np.concatenate(keys), return_counts=True)
        block = slots >> BLOCK_BITS
        offset = (slots & ((1 << BLOCK_BITS) - 1)).astype(np.uint32)
        cut = np.append(np.append(0, np.flatnonzero(np.diff(block)) + 1), len(slots))
        parts = [slice(a, b) for a, b in zip(cut, cut[1:])]
        return pa.RecordBatch.from_arrays(
            [pa.array(block[cut[:-1]]), pa.array([offset[p].tobytes() for p in parts], pa.binary()),
             pa.array([offset[p][times[p] > 1].tobytes() for p in parts], pa.binary())], ["block", "seen", "again"])

    held, size = [], 0
    for b in batches:
        held.append(b.column("slot").to_numpy())
        size += b.num_rows
        if size >= PACKED:
            yield rows(held)
            held, size = [], 0
    if size:
        yield rows(held)


def _again(batches):
    """Slots seen more than once, from the rows of ``_packed`` in the order of their blocks."""
    block, once, twice = None, np.zeros(1 << BLOCK_BITS, bool), np.zeros(1 << BLOCK_BITS, bool)

    def result():
        return pa.RecordBatch.from_arrays([pa.array((block << BLOCK_BITS) + np.flatnonzero(twice))], ["slot"])

    for b in batches:
        for own, seen, again in zip(*(c.to_pylist() for c in b.columns)):
            if own != block:
                if block is not None:
                    yield result()
                block = own
                once[:], twice[:] = False, False
            seen = np.frombuffer(seen, np.uint32)
            twice[seen[once[seen]]] = True
            twice[np.frombuffer(again, np.uint32)] = True
            once[seen] = True
    if block is not None:
        yield result()


def slot_of(event_id: str, rows: int) -> Column:
    bits = max(BLOCK_BITS, math.ceil(math.log2(max(1, rows) * SLOTS_PER_ROW)))
    return F.xxhash64(event_id).bitwiseAND(F.lit((1 << bits) - 1))


def repeated_slots(raw: DataFrame) -> tuple[DataFrame, Column] | None:
    """The hash slots of ``event_id`` that more than one row falls into, and a row's slot; None if they are too many."""
    spark = raw.sparkSession
    ship_package(spark)
    ids = raw.select("event_id").where(F.col("event_id").isNotNull())
    slot = slot_of("event_id", ids.count())
    packed = ids.select(slot.alias("slot")).mapInArrow(_packed, "block long, seen binary, again binary")
    path = scratch_folder(spark, "repeated-slots")
    packed.repartition("block").sortWithinPartitions("block").mapInArrow(_again, "slot long").write.parquet(path)
    slots = spark.read.schema("slot long").parquet(path)
    return (slots, slot) if slots.count() <= MOST_SLOTS else None


def possible_duplicates(raw: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows with an event id that may occur again, and those whose id surely does not (None: not known of any)."""
    known = raw.filter(F.col("event_id").isNotNull())
    found = repeated_slots(raw)
    if found is None:
        return known, None
    slots, slot = found
    marked = known.withColumn("_slot", slot)
    table = F.broadcast(slots.withColumnRenamed("slot", "_slot"))  # at most MOST_SLOTS rows
    return marked.join(table, "_slot", "left_semi").drop("_slot"), marked.join(table, "_slot", "left_anti").drop("_slot")


def duplicate_ids(raw: DataFrame) -> DataFrame:
    """Non-NULL event ids that occur more than once in the raw feed."""
    return (possible_duplicates(raw)[0]
            .groupBy("event_id").agg(F.count(F.lit(1)).alias("n_copies"))
            .filter(F.col("n_copies") > 1))


def deduplicate(raw: DataFrame) -> DataFrame:
    """One row per non-NULL event_id plus ``dq_duplicate_event_id``."""
    possible, single = possible_duplicates(raw)
    best = F.min(F.struct(*_nulls_last_key(DEDUP_ORDER))).alias("_best")  # the order holds every payload column
    agg = possible.groupBy("event_id").agg(F.count(F.lit(1)).alias("_copies"), best)
    chosen = agg.select(
        "event_id",
        *[F.col(f"_best._k{DEDUP_ORDER.index(c)}").alias(c) for c in PAYLOAD],
        (F.col("_copies") > 1).alias("dq_duplicate_event_id"),
    )
    if single is None:
        return chosen
    return single.select("event_id", *PAYLOAD, F.lit(False).alias("dq_duplicate_event_id")).union(chosen)


def repair_time(events: DataFrame, json_key: str = "client_event_time") -> DataFrame:
    """event_time -> client time in the JSON payload -> ingested_at.

    The payload is parsed once, to a VARIANT. An absent key, a JSON null, an
    unparsable value and a payload that is no JSON all count as "no client
    time"; ``dq_null_client_time``, ``dq_bad_client_time`` and
    ``dq_malformed_payload`` (for events with a time as well) tell them apart.
    """
    missing = F.col("event_time").isNull()
    value = F.variant_get("_payload", f"$.{json_key}", "variant")
    return (events
            .withColumn("_payload", F.try_parse_json("properties_json"))
            .withColumn("dq_malformed_payload", F.col("properties_json").isNotNull() & F.col("_payload").isNull())
            .withColumn("_text", F.when(missing, F.try_variant_get("_payload", f"$.{json_key}", "string")))
            .withColumn("dq_null_client_time", missing & F.coalesce(F.is_variant_null(value), F.lit(False)))
            .withColumn("_client", F.col("_text").try_cast("timestamp"))
            .withColumn("dq_bad_client_time", F.col("_text").isNotNull() & F.col("_client").isNull())
            .withColumn("event_time_final", F.coalesce("event_time", "_client", "ingested_at"))
            .withColumn("dq_missing_event_time", F.col("event_time").isNull())
            .withColumn("dq_used_client_time", F.col("event_time").isNull() & F.col("_client").isNotNull())
            .withColumn("dq_used_ingested_time", F.col("event_time").isNull() & F.col("_client").isNull())
            .drop("_client", "_text", "_payload"))


def standardise_fields(events: DataFrame, devices=config.DEVICE_TYPES,
                       countries=config.COUNTRY_CODES) -> DataFrame:
    """Allowed-list standardisation plus NULL-preserving out-of-domain flags."""
    return events.select(
        "*",
        standardise("device_type", devices).alias("_device"),
        standardise("country", countries).alias("_country"),
        out_of_domain("device_type", devices).alias("dq_bad_device"),
        out_of_domain("country", countries).alias("dq_bad_country"),
    ).drop("device_type", "country").withColumnRenamed("_device", "device_type") \
     .withColumnRenamed("_country", "country")


def external_users(users: DataFrame) -> DataFrame:
    """Users that are not internal (NULL ``is_internal`` counts as external)."""
    return users.filter(~F.coalesce(F.col("is_internal"), F.lit(False)))


FCT_EVENTS_COLUMNS = (
    "event_id", "user_id", "event_name", "event_time_final", "feature_name", "session_id",
    "device_type", "country", "properties_json", "ingested_at",
    "dq_missing_event_time", "dq_used_client_time", "dq_used_ingested_time",
    "dq_bad_client_time", "dq_null_client_time", "dq_malformed_payload", "dq_duplicate_event_id", "dq_bad_device", "dq_bad_country",
)


def clean_events(raw: DataFrame, users: DataFrame, devices=config.DEVICE_TYPES,
                 countries=config.COUNTRY_CODES) -> DataFrame:
    """Composite C: ``raw_events`` x ``dim_users`` -> ``fct_events``."""
    ev = deduplicate(raw)
    ev = repair_time(ev)
    ev = standardise_fields(ev, devices, countries)
    ev = ev.join(external_users(users).select("user_id"), "user_id", "left_semi")
    return ev.select(*FCT_EVENTS_COLUMNS)


def dq_flag_counts(fct_events: DataFrame) -> DataFrame:
    """One-row summary of the data-quality flags carried by ``fct_events``."""
    flags = ("dq_missing_event_time", "dq_used_client_time", "dq_used_ingested_time", "dq_bad_client_time",
             "dq_null_client_time", "dq_malformed_payload", "dq_duplicate_event_id", "dq_bad_device", "dq_bad_country")
    aggs = [F.count(F.lit(1)).alias("n_events")]
    aggs += [F.count_if(F.col(f)).alias(f"n_{f[3:]}") for f in flags]
    aggs += [F.count_if(F.col(f).isNull()).alias(f"n_{f[3:]}_null") for f in ("dq_bad_device", "dq_bad_country")]
    return fct_events.agg(*aggs)
