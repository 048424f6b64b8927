"""The key index: what it finds, what it opens, replays and folding."""

import random
from uuid import uuid4

from pyspark.sql import functions as F

from inkwell.session import shared_dir
from inkwell.sinks.index import KeyIndex


def rows(spark, keys, stamp=0):
    return spark.createDataFrame([(k, stamp) for k in keys], "url_key string, stamp long")


def found(index, spark, keys, before=None):
    return {r.url_key: r.stamp for r in index.lookup(rows(spark, keys), before).collect()}


def test_rows_opened_do_not_grow_with_age(spark):
    index = KeyIndex(spark, f"{shared_dir(spark)}/index-{uuid4().hex}", part_rows=50, fan_in=3)
    r = random.Random(1)
    seen, opened = [], []
    for batch in range(10):
        new = [f"key {batch} {i}" for i in range(400)]
        old = r.sample(seen, 6) if seen else []
        hits = found(index, spark, new + old, before=batch)
        assert set(hits) == set(old)
        opened.append(index.opened)
        index.add(rows(spark, new, stamp=2 * batch), batch)
        seen += new
    # six known keys a batch: some parts of 50 keys each, while the index grows to 3,600 keys
    assert all(o.rows <= 25 * 60 for o in opened[1:]) and max(o.rows for o in opened[5:]) <= 2 * max(o.rows for o in opened[1:5])
    assert len(index.runs()) <= 6 and index.covered() == set(range(10))
    assert index.vacuum(8) >= 6 and index.covered() == set(range(10))
    assert found(index, spark, seen).keys() == set(seen)


def test_replay_latest_stamp_and_nulls(spark):
    index = KeyIndex(spark, f"{shared_dir(spark)}/index-{uuid4().hex}", fan_in=2)
    assert found(index, spark, ["a"]) == {}
    index.add(rows(spark, ["a", "b", None, "a"], 4), 0)
    index.add(rows(spark, ["a", "c"], 7), 1)
    assert found(index, spark, ["a", "b", "c", None, "d"]) == {"a": 7, "b": 4, "c": 7}
    assert found(index, spark, ["a", "c"], before=1) == {"a": 4}
    index.add(rows(spark, ["d"], 9), 1)  # the replayed batch held something else
    index.add(rows(spark, [], 9), 2)
    index.add(rows(spark, ["e"] * 500, 9), 3)
    assert found(index, spark, ["a", "c", "d", "e"]) == {"a": 4, "d": 9, "e": 9}
    assert [(r.first, r.last) for r in index.runs()] == [(0, 1), (2, 2), (3, 3)]


def test_ledger_reads_batches_that_the_index_lacks(spark):
    from inkwell import schemas
    from inkwell.sinks.tables import LedgerTable

    ledger = LedgerTable(spark, f"{shared_dir(spark)}/ledger-{uuid4().hex}")
    blank = {f.name: F.lit(None).cast(f.dataType) for f in schemas.LEDGER.fields}

    def batch(keys, status, at):
        given = {"url_key": F.explode(F.array(*map(F.lit, keys))), "status": F.lit(status), "processed_at": F.lit(at).cast("timestamp_ntz")}
        return spark.range(1).select(*[e.alias(n) for n, e in (blank | given).items()])

    ledger.batches.write(batch(["old", "again"], "COMPLETED", "2024-01-01 00:00:00"), 0)  # written before there was an index
    ledger.write(batch(["new"], "COMPLETED", "2024-01-02 00:00:00"), 1)
    ledger.write(batch(["again"], "REPROCESS", "2024-01-03 00:00:00"), 2)
    keys = rows(spark, ["old", "again", "new", "other"])
    assert {r.url_key for r in ledger.done(keys).collect()} == {"old", "new"}
    assert {r.url_key for r in ledger.done(keys, before=1).collect()} == {"old", "again"}
    assert ledger.next_batch() == 3
