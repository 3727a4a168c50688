import pyarrow as pa
from pyspark.sql import functions as F

from productlens.operators import clean as C
from tests.conftest import by_key, raw_row, user_row

USERS = [user_row("u1"), user_row("u2"), user_row("u_int", is_internal=True), user_row("u_null", is_internal=None)]


def test_dedup_keeps_earliest_ingestion_and_flags(make_raw, make_users):
    raw = make_raw([
        raw_row("e1", "u1", session_id="late", ingested_at="2024-01-03 01:00:00"),
        raw_row("e1", "u1", session_id="early", ingested_at="2024-01-03 00:00:00"),
        # equal ingestion: the total order decides (session_id 'a' < 'b')
        raw_row("e2", "u1", session_id="b"),
        raw_row("e2", "u1", session_id="a"),
        # NULL ingestion sorts last
        raw_row("e3", "u1", session_id="nullingest", ingested_at=None),
        raw_row("e3", "u1", session_id="ingested"),
        raw_row(None, "u1"),  # NULL ids are dropped
        raw_row("e4", "u2"),
        # one id shared by two users: one row survives
        raw_row("e5", "u1", ingested_at="2024-01-03 00:00:01"),
        raw_row("e5", "u2", ingested_at="2024-01-03 00:00:00"),
    ])
    out = by_key(C.clean_events(raw, make_users(USERS)).collect(), "event_id")
    assert set(out) == {"e1", "e2", "e3", "e4", "e5"}
    assert out["e1"]["session_id"] == "early" and out["e1"]["dq_duplicate_event_id"]
    assert out["e2"]["session_id"] == "a"
    assert out["e3"]["session_id"] == "ingested"
    assert not out["e4"]["dq_duplicate_event_id"]
    assert out["e5"]["user_id"] == "u2"


def test_duplicate_ids_counts_raw_rows(make_raw):
    raw = make_raw([raw_row("e1", "u1"), raw_row("e1", "u2"), raw_row("e1", "u1"), raw_row("e2", "u1"),
                    raw_row(None, "u1"), raw_row(None, "u1")])
    rows = {r["event_id"]: r["n_copies"] for r in C.duplicate_ids(raw).collect()}
    assert rows == {"e1": 3}


def test_time_repair_priority_and_flags(make_raw, make_users):
    ok = '{"client_event_time":"2024-01-02T05:06:07.000001"}'
    raw = make_raw([
        raw_row("a", "u1", event_time="2024-01-02 10:00:00", properties_json=ok),
        raw_row("b", "u1", event_time=None, properties_json=ok),
        raw_row("c", "u1", event_time=None, properties_json='{"screen":"app"}'),
        raw_row("d", "u1", event_time=None, properties_json='{"client_event_time":null}'),
        raw_row("e", "u1", event_time=None, properties_json='{"client_event_time":"not a time"}'),
        raw_row("f", "u1", event_time=None, properties_json=None),
    ])
    out = by_key(C.clean_events(raw, make_users(USERS))
                 .withColumn("t", F.date_format("event_time_final", "yyyy-MM-dd HH:mm:ss.SSSSSS")).collect(),
                 "event_id")
    assert out["a"]["t"] == "2024-01-02 10:00:00.000000"
    assert not out["a"]["dq_missing_event_time"] and not out["a"]["dq_used_client_time"]
    assert out["b"]["t"] == "2024-01-02 05:06:07.000001"
    assert out["b"]["dq_used_client_time"] and not out["b"]["dq_used_ingested_time"]
    for k in "cdef":
        assert out[k]["t"] == "2024-01-03 00:00:00.000000", k
        assert out[k]["dq_missing_event_time"] and out[k]["dq_used_ingested_time"]
        assert not out[k]["dq_used_client_time"]


def test_standardisation_and_null_preserving_flags(make_raw, make_users):
    raw = make_raw([
        raw_row("a", "u1", device_type="mobile", country="DE"),
        raw_row("b", "u1", device_type="unkn0wn", country="XX"),
        raw_row("c", "u1", device_type=None, country=None),
    ])
    out = by_key(C.clean_events(raw, make_users(USERS)).collect(), "event_id")
    assert (out["a"]["device_type"], out["a"]["country"]) == ("mobile", "DE")
    assert (out["a"]["dq_bad_device"], out["a"]["dq_bad_country"]) == (False, False)
    assert (out["b"]["device_type"], out["b"]["country"]) == ("unknown", "unknown")
    assert (out["b"]["dq_bad_device"], out["b"]["dq_bad_country"]) == (True, True)
    assert (out["c"]["device_type"], out["c"]["country"]) == ("unknown", "unknown")
    assert (out["c"]["dq_bad_device"], out["c"]["dq_bad_country"]) == (None, None)


def test_internal_and_unknown_users_removed(make_raw, make_users):
    raw = make_raw([raw_row("a", "u1"), raw_row("b", "u_int"), raw_row("c", "u_null"), raw_row("d", "nobody"),
                    raw_row("e", None)])
    out = {r["event_id"] for r in C.clean_events(raw, make_users(USERS)).collect()}
    assert out == {"a", "c"}


def test_dq_flag_counts(make_raw, make_users):
    raw = make_raw([raw_row("a", "u1", event_time=None), raw_row("a", "u1"), raw_row("b", "u1", device_type=None)])
    row = C.dq_flag_counts(C.clean_events(raw, make_users(USERS))).collect()[0]
    assert row["n_events"] == 2
    assert row["n_duplicate_event_id"] == 1
    assert row["n_bad_device_null"] == 1


def test_dedup_buffer_holds_each_column_once(spark, make_raw):
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = C.deduplicate(make_raw([raw_row("1", "u1")]))._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    struct = plan[plan.index("min(struct"):].split(" AS _best")[0]
    assert all(struct.count(f"{c}#") == 2 for c in C.DEDUP_ORDER), struct  # its NULL flag and its value


def test_bad_client_times_are_counted(spark, make_raw, make_users):
    raw = make_raw([raw_row("1", "u1", event_time=None, properties_json='{"client_event_time":"n/a"}'),
                    raw_row("2", "u1", event_time=None, properties_json='{"client_event_time":null}'),
                    raw_row("3", "u1", event_time=None, properties_json='{"client_event_time":"2024-01-01T00:00:00"}'),
                    raw_row("4", "u1", properties_json='{"client_event_time":"n/a"}')])
    counts = C.dq_flag_counts(C.clean_events(raw, make_users([user_row("u1")]))).collect()[0]
    assert (counts["n_bad_client_time"], counts["n_used_client_time"], counts["n_used_ingested_time"]) == (1, 1, 2)


def test_only_possible_duplicates_are_shuffled(spark):
    from productlens import schemas
    rows = [raw_row(f"e{i}", "u1", session_id=f"s{i % 3}") for i in range(20_000)] + [raw_row(None, "u1")] * 50
    rows += [raw_row(f"e{i}", "u1", session_id="copy") for i in range(0, 20_000, 100)] + [raw_row("hot", "u1")] * 3000
    raw = spark.createDataFrame(rows, schemas.RAW_EVENTS)
    possible, single = C.possible_duplicates(raw)
    assert possible.count() + single.count() == 23_200
    assert single.count() == single.select("event_id").distinct().count()
    assert single.join(possible, "event_id").count() == 0
    # without the copies of the ids that do occur again, far below a tenth of the rows goes to the exact aggregation
    assert possible.select("event_id").distinct().count() < 0.05 * len(rows)
    slots, _ = C.repeated_slots(raw)
    packed = raw.where("event_id is not null").select(C.slot_of("event_id", len(rows)).alias("slot")).mapInArrow(
        C._packed, "block long, seen binary, again binary")
    assert packed.count() < 0.1 * len(rows) and slots.count() <= possible.select("event_id").distinct().count()
    assert {r["event_id"]: r["n_copies"] for r in C.duplicate_ids(raw).collect()} == {
        "hot": 3000, **{f"e{i}": 2 for i in range(0, 20_000, 100)}}


def test_dedup_is_the_same_whatever_the_map(spark, make_raw, monkeypatch):
    rows = [raw_row(f"e{i % 400}", "u1", session_id=f"s{i % 7}", ingested_at=None if i % 5 == 0 else "2024-01-03 00:00:00")
            for i in range(700)] + [raw_row(None, "u1")]
    want = sorted(map(str, C.deduplicate(make_raw(rows)).collect()))
    assert len(want) == 400
    monkeypatch.setattr(C, "MOST_SLOTS", 10)   # too many slots: everything through the exact aggregation
    assert C.possible_duplicates(make_raw(rows))[1] is None
    assert sorted(map(str, C.deduplicate(make_raw(rows)).collect())) == want
    monkeypatch.undo()
    blocks = [[(b, s) for b, s in ((7, 1), (7, 2), (7, 1), (8, 1))], [(7, 2), (8, 3)]]
    packed = [list(C._packed(iter([pa.RecordBatch.from_pydict({"slot": [(b << C.BLOCK_BITS) + s for b, s in own]})])))[0]
              for own in blocks]
    by_block = pa.Table.from_batches(packed).sort_by("block").to_batches()
    got = [x.as_py() for b in C._again(iter(by_block)) for x in b.column("slot")]
    assert got == [(7 << C.BLOCK_BITS) + 1, (7 << C.BLOCK_BITS) + 2]


def test_dedup_of_no_rows(make_raw):
    assert C.deduplicate(make_raw([])).count() == 0 and C.duplicate_ids(make_raw([raw_row(None, "u1")])).count() == 0


def test_payload_states_are_told_apart(make_raw, make_users):
    raw = make_raw([
        raw_row("absent", "u1", event_time=None, properties_json='{"screen":"app"}'),
        raw_row("null", "u1", event_time=None, properties_json='{"client_event_time":null}'),
        raw_row("bad", "u1", event_time=None, properties_json='{"client_event_time":"soon"}'),
        raw_row("cut", "u1", event_time=None, properties_json='{"client_event_time":"2024-01-01T00:00:00"'),
        raw_row("cut2", "u1", properties_json="{"), raw_row("none", "u1", event_time=None, properties_json=None),
        raw_row("timed", "u1", properties_json='{"client_event_time":null}'),
        raw_row("number", "u1", event_time=None, properties_json='{"client_event_time":{"a":1}}'),
    ])
    cleaned = C.clean_events(raw, make_users(USERS))
    flags = {r["event_id"]: (r["dq_null_client_time"], r["dq_bad_client_time"], r["dq_malformed_payload"]) for r in cleaned.collect()}
    assert flags == {"absent": (False, False, False), "null": (True, False, False), "bad": (False, True, False),
                     "cut": (False, False, True), "cut2": (False, False, True), "none": (False, False, False),
                     "timed": (False, False, False), "number": (False, True, False)}
    counts = C.dq_flag_counts(cleaned).collect()[0]
    assert (counts["n_null_client_time"], counts["n_bad_client_time"], counts["n_malformed_payload"]) == (1, 2, 2)
