"""Control replay, backlog and queue depth against sequential loops."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from inkwell import schemas
from inkwell.operators import control as K
from inkwell.operators.timeline import Slicing

T0 = datetime(2024, 1, 1)
COMMANDS = ["start", "stop", "toggle", "reset", "state"]


def make_log(n=3000, hot=0.4, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        inst = "hot" if rnd.random() < hot else f"i{rnd.randint(0, 30)}"
        # several commands share a second, order then follows the id
        rows.append((i, inst, T0 + timedelta(seconds=rnd.randint(0, 40000) // 7 * 7), rnd.choice(COMMANDS)))
    return rows


def sequential(rows):
    state, out = {}, {}
    for cid, inst, ts, cmd in sorted(rows, key=lambda r: (r[2], r[0])):
        before = state.get(inst, 0)
        after = {"start": 1, "stop": 0, "reset": 0, "toggle": 1 - before}.get(cmd, before)
        state[inst] = after
        out[cid] = (before, after)
    return out


def test_replay_matches_loop(spark):
    rows = make_log()
    # all keys sliced, only the hot one, none; and fewer slots than hot keys
    for slicing in (Slicing(60), Slicing(3600), Slicing(), Slicing(1)):
        got = K.control_replay(spark.createDataFrame(rows, schemas.CONTROL_LOG), slicing).collect()
        assert {r.cmd_id: (r.state_before, r.state_after) for r in got} == sequential(rows)
        assert all(r.changed == (r.state_before != r.state_after) for r in got)
        assert all(r.reported_change == (r.changed or r.cmd == "reset") for r in got)


def test_replay_edges(spark):
    rows = [
        (1, "a", T0, "toggle"), (2, "a", T0 + timedelta(days=3), "state"), (3, "a", T0 + timedelta(days=9), "toggle"),
        (4, "b", T0, "reset"), (5, "c", T0, "start"), (6, "c", T0 + timedelta(hours=5), "START"), (7, None, T0, "start"),
        (8, None, T0 + timedelta(days=1), "state"), (9, "before1970", datetime(1969, 12, 31, 23), "start"),
        (10, "before1970", datetime(1970, 1, 1, 1), "state"),
    ]
    got = {r.cmd_id: r for r in K.control_replay(spark.createDataFrame(rows, schemas.CONTROL_LOG), Slicing(3600)).collect()}
    assert [got[i].state_after for i in range(1, 11)] == [1, 1, 0, 0, 1, 1, 1, 1, 1, 1]
    assert [got[i].changed for i in (1, 2, 3, 4, 5, 6)] == [True, False, True, False, True, False]
    assert got[4].reported_change


def test_state_as_of(spark):
    rows = [(1, "a", T0, "start"), (2, "a", T0 + timedelta(hours=2), "start"), (3, "a", T0 + timedelta(hours=4), "stop"), (4, "b", T0, "state")]
    replay = K.control_replay(spark.createDataFrame(rows, schemas.CONTROL_LOG))
    now = {r.instance_id: r for r in K.control_state(replay).collect()}
    assert (now["a"].status, now["a"].last_changed, now["a"].reason) == ("STOPPED", T0 + timedelta(hours=4), K.STOPPED_REASON)
    assert (now["b"].status, now["b"].last_changed, now["b"].reason) == ("STOPPED", None, K.STARTUP_REASON)
    past = {r.instance_id: r for r in K.control_state(replay, F.lit(T0 + timedelta(hours=3))).collect()}
    assert (past["a"].status, past["a"].last_changed, past["a"].reason) == ("STARTED", T0, K.STARTED_REASON)


def test_responses(spark):
    rows = [(1, "a", T0, "toggle"), (2, "a", T0 + timedelta(hours=1), "toggle"), (3, "a", T0 + timedelta(hours=2), "reset")]
    got = {r.cmd_id: r for r in K.control_response(K.control_replay(spark.createDataFrame(rows, schemas.CONTROL_LOG))).collect()}
    assert got[1].message == (
        "Processing started successfully. Previous state: disabled, Current state: enabled. Now consuming messages from queue."
    )
    assert got[2].action == "stopped" and got[2].consumer_status == "IDLE"
    assert got[3].state_changed and got[3].action is None


def test_backlog_and_depth(spark):
    rnd = random.Random(5)
    log = make_log(800)
    arr = [(r[1], T0 + timedelta(seconds=rnd.randint(0, 45000), microseconds=500), 100000 + i) for i, r in enumerate(make_log(1500, seed=9))]
    replay = K.control_replay(spark.createDataFrame(log, schemas.CONTROL_LOG))
    arrivals = spark.createDataFrame(arr, "instance_id string, ts timestamp, event_id long")
    consumed = K.consume_backlog(arrivals, replay, slicing=Slicing(1800))
    got = {r.event_id: r for r in consumed.collect()}
    assert len(got) == len(arr)
    states = sequential(log)
    ordered = sorted(log, key=lambda r: (r[2], r[0]))
    for inst, ts, eid in arr:
        past = [states[r[0]][1] for r in ordered if r[1] == inst and r[2] <= ts]
        starts = [r[2] for r in ordered if r[1] == inst and r[2] > ts and states[r[0]] == (0, 1)]
        want = ts if past and past[-1] == 1 else (starts[0] if starts else None)
        assert got[eid].consumed_at == want, (inst, ts)
    series = K.queue_depth_series(consumed, slicing=Slicing(900)).collect()
    by_inst = {}
    for r in sorted(series, key=lambda r: r.ts):
        depth = by_inst.get(r.instance_id, 0) + r.arrived - r.taken
        by_inst[r.instance_id] = depth
        assert r.depth == depth >= 0
    waiting = sum(1 for r in got.values() if r.consumed_at is None)
    assert sum(by_inst.values()) == waiting
