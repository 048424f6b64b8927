"""Monitoring messages: payloads, registry, liveness, error tracking."""

import json
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from inkwell.operators import monitoring as MO
from inkwell.operators.timeline import Slicing

T0 = datetime(2024, 1, 1)

BOOT_MS = 1_700_000_000_123  # 2023-11-14 22:13:20.123 UTC


def message(event, status, seconds, stage, **more):
    """A full message so many seconds after the boot, in a zone five and a half hours ahead."""
    local = datetime(2023, 11, 15, 3, 43, 20, 123000) + timedelta(seconds=seconds)
    return {
        "instanceId": "parse-7@rack3", "timestamp": local.isoformat(timespec="milliseconds") + "+05:30",
        "event": event, "status": status, "uptime": f"{seconds}s", "hostname": "rack3", "publicHostname": "rack3.example.net",
        "url": "https://rack3.example.net/parse", "bootEpoch": BOOT_MS, "version": "7.2-test", "filesProcessed": 0, "filesTotal": 0,
        "errorCount": 0, "memoryUsedMB": 61, "meta": {"service": "parse", "processingStage": stage, "inputMode": "queue"},
    } | more


INIT = message("INIT", "STARTING", 0, "starting")
HEARTBEAT = message(
    "HEARTBEAT", "RUNNING", 75, "processing", currentFile="books/17.epub", filesProcessed=9, filesTotal=31, totalChunks=88, processedChunks=41,
    processingRate=0.125, lastError=None, memoryUsedMB=73, pendingMessages=12,
)
ERROR = message("ERROR", "ERROR", 200, "error", filesProcessed=10, errorCount=2, lastError="no reader for books/18.xyz")
SHORT = {  # no event, no url, no stage: valid for the short list of required fields only
    "instanceId": "embed-1", "timestamp": "2023-11-14T22:15:00Z", "status": "PROCESSING", "processingRate": 6.75, "pendingMessages": 4,
    "meta": {"service": "embed"},
}
EPOCH_MS = {**HEARTBEAT, "timestamp": BOOT_MS, "meta": {"service": "q", "processingStage": "idle", "tags": {"rack": "r-3"}}}


def parsed(spark, docs):
    rows = [(i, d if isinstance(d, (str, type(None))) else json.dumps(d)) for i, d in enumerate(docs)]
    return MO.parse_metrics(spark.createDataFrame(rows, "event_id int, value string")).orderBy("event_id")


def test_full_short_and_numeric_messages_parse(spark):
    rows = parsed(spark, [INIT, HEARTBEAT, ERROR, SHORT, EPOCH_MS]).collect()
    boot = datetime(2023, 11, 14, 22, 13, 20, 123000)
    assert rows[0].ts == boot and rows[0].bootEpoch == BOOT_MS
    assert rows[1].ts == boot + timedelta(seconds=75)
    assert (rows[1].processedChunks, rows[1].processingRate, rows[1].meta.processingStage) == (41, 0.125, "processing")
    assert (rows[2].lastError, rows[2].errorCount) == ("no reader for books/18.xyz", 2)
    assert rows[3].event is None and rows[3].ts == datetime(2023, 11, 14, 22, 15)
    assert rows[4].ts == boot and rows[4].meta.tags == {"rack": "r-3"}
    assert [r.meta.tags for r in rows[:4]] == [{}] * 4  # absent tags are an empty map
    assert not any(r.malformed for r in rows)


def test_validation(spark):
    bad = {**INIT, "status": "FINE", "timestamp": "soon"}
    rows = parsed(spark, [INIT, HEARTBEAT, ERROR, SHORT, bad, '{"inst', None])
    full = [r.violations for r in MO.validate_metrics(rows).collect()]
    assert full == [
        [], [], [], ["missing:event", "missing:url", "missing:meta.processingStage"], ["format:timestamp", "value:status"],
        ["malformed"], ["malformed"],
    ]
    assert MO.validate_metrics(rows, MO.REQUIRED_BASIC).collect()[3].violations == []


def test_json_round_trip(spark):
    m = parsed(spark, [HEARTBEAT])
    again = json.loads(MO.metrics_json(m).collect()[0].value)
    want = {k: v for k, v in HEARTBEAT.items() if v is not None}
    assert again == want | {"meta": want["meta"] | {"tags": {}}}


def stream(spark, rows):
    """rows: (id, instance, seconds, event)"""
    data = [(i, "s", inst, T0 + timedelta(seconds=sec), ev, "boom" if ev == "ERROR" else None) for i, inst, sec, ev in rows]
    return spark.createDataFrame(data, "event_id long, service string, instanceId string, ts timestamp, event string, lastError string")


def test_liveness_and_stale(spark):
    rows = [
        (1, "a", 70, "HEARTBEAT"), (2, "b", 69.999, "HEARTBEAT"), (3, "c", -20, "FILE_START"), (4, "d", -20.001, "INIT"),
        (5, "e", 100, "HEARTBEAT"), (6, "e", 99.9, "SHUTDOWN"), (7, "f", 99, "SHUTDOWN"), (8, "g", 80, "INIT"), (9, "h", 79.999, "INIT"),
    ]
    live = MO.with_liveness(MO.instance_registry(stream(spark, rows)), F.lit(T0 + timedelta(seconds=100)))
    got = {r.instanceId: (r.liveness, r.hb_stale) for r in live.collect()}
    assert got == {
        "a": ("Alive", True), "b": ("Degraded", True), "c": ("Degraded", True), "d": ("Offline", True), "e": ("Alive", False),
        "f": ("Stopped", True), "g": ("Alive", False), "h": ("Alive", True),
    }
    rolled = {(r.service, r.liveness): r.n_instances for r in MO.service_rollup(live).collect()}
    assert rolled[("s", "Alive")] == 4 and rolled[("s", "Stopped")] == 1


def random_rows(n=2000):
    rnd = random.Random(11)
    events = ["INIT", "HEARTBEAT", "ERROR", "FILE_START", "FILE_COMPLETE"]
    return [(i, "hot" if rnd.random() < 0.4 else f"i{rnd.randint(0, 9)}", rnd.randint(0, 50000), rnd.choice(events)) for i in range(n)]


def test_running_values_match_loops(spark):
    rows = random_rows()
    m = stream(spark, rows)
    errors = {r.event_id: (r.errorCount, r.lastError) for r in MO.error_tracking(m, slicing=Slicing(700)).collect()}
    boots = {r.event_id: r.bootEpoch for r in MO.boot_epochs(m, slicing=Slicing(700)).collect()}
    missed = {r.event_id: (r.previous_ts, r.missed) for r in MO.missed_heartbeats(m, 60, slicing=Slicing(700)).collect()}
    status = {
        r.event_id: r.mapped_status
        for r in MO.status_mapping(m.withColumn("status", F.col("event")), F.lit(True), 300, slicing=Slicing(700)).collect()
    }
    seen, n_err, last_err, boot, beat, work = set(), {}, {}, {}, {}, {}
    for i, inst, sec, ev in sorted(rows, key=lambda r: (r[2], r[0])):
        ts = T0 + timedelta(seconds=sec)
        if ev == "ERROR":
            n_err[inst], last_err[inst] = n_err.get(inst, 0) + 1, "boom"
        if ev == "INIT":
            boot[inst] = 1704067200000 + sec * 1000
        if ev in ("FILE_START", "FILE_COMPLETE"):
            work[inst] = sec
        if ev in ("INIT", "HEARTBEAT"):
            if inst in beat and (sec - beat[inst]) * 10**6 - 1 >= 60 * 10**6:
                assert missed[i] == (T0 + timedelta(seconds=beat[inst]), ((sec - beat[inst]) * 10**6 - 1) // (60 * 10**6))
                seen.add(i)
            beat[inst] = sec
        assert errors[i] == (n_err.get(inst, 0), last_err.get(inst))
        assert boots[i] == boot.get(inst)
        want = "ERROR" if ev == "ERROR" else "PROCESSING" if inst in work and sec - work[inst] <= 300 else "IDLE"
        assert status[i] == want
    assert seen == set(missed)


def test_counts_rates_and_restarts(spark):
    rows = [(1, "a", 0, "INIT"), (2, "a", 90, "FILE_COMPLETE"), (3, "a", 90, "FILE_COMPLETE"), (4, "a", 100, "INIT"), (5, "b", 5, "HEARTBEAT")]
    m = stream(spark, rows).withColumn("version", F.concat(F.lit("v"), "event_id")).withColumn("status", F.lit("RUNNING")).withColumn("hostname", F.lit("h"))
    rates = {r.instanceId: r for r in MO.instance_rates(m).collect()}
    assert (rates["a"].rate, rates["a"].uptime, rates["b"].rate) == (0.02, "0h 1m", 0.0)
    again = {r.instanceId: r for r in MO.restarts(MO.boot_epochs(m)).collect()}
    assert (again["a"].boots, again["a"].restarts, again["a"].version) == (2, 1, "v4") and again["b"].restarts == 0
    inits = MO.init_messages(MO.boot_epochs(m)).orderBy("ts").collect()
    assert [(r.instanceId, r.version, r.uptime, r.filesTotal) for r in inits] == [("a", "v1", "0s", -1), ("a", "v4", "0s", -1)]
    assert tuple(MO.dashboard_counts(m).collect()[0]) == (5, 5, 0)


def test_search(spark):
    df = spark.createDataFrame([("abc Error",), ("ok",), (None,)], "value string")
    assert MO.search_events(df, "ERROR").count() == 1
