"""The prefix scan: how rows are dealt, and running values against loops."""

import random
from collections import Counter
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from inkwell.operators import timeline as TL


def log(spark, rows):
    return spark.createDataFrame(rows, "k string, ts timestamp, id long, v long")


def moments(r, n, keys):
    start = datetime(2024, 1, 1)
    return [(r.choice(keys), start + timedelta(seconds=r.randrange(n)), i, r.choice([None, 1, 2, 3])) for i in range(n)]


def test_one_key_is_spread_over_all_ranges(spark):
    rows = moments(random.Random(1), 20_000, ["only"])
    line = TL.Timeline(["k"], ["ts", "id"], TL.Slicing(16))
    per_range = sorted(r["count"] for r in line.sliced(log(spark, rows)).groupBy(TL.SLICE).count().collect())
    assert len(per_range) == 16 and per_range[-1] <= 2 * per_range[8]


def test_ranges_rise_with_key_and_order_and_keep_equal_rows(spark):
    rows = moments(random.Random(2), 3000, ["a", "b", None, "é", ""]) + [("b", datetime(2024, 1, 1), 7, 1)] * 500 + [("a", None, 1, 1)] * 3
    got = log(spark, rows).withColumn("p", TL.range_number(log(spark, rows), ["k", "ts", "id"], 10)).collect()
    key = lambda r: (r.k is not None, (r.k or "").encode(), r.ts is not None, r.ts or datetime.min, r.id)
    numbers = [r.p for r in sorted(got, key=key)]
    assert numbers == sorted(numbers) and len(set(numbers)) >= 8
    assert len({r.p for r in got if (r.k, r.ts, r.id) == ("b", datetime(2024, 1, 1), 7)}) == 1


def test_running_values_match_loops(spark):
    rows = moments(random.Random(3), 900, ["a", "a", "a", "b", None])
    for parts in (1, 2, 7, 300):
        line = TL.Timeline(["k"], ["ts", "id"], TL.Slicing(parts))
        sums = {r.id: r.s for r in TL.running_sum(log(spark, rows), line, F.coalesce("v", F.lit(0)), "s").collect()}
        lasts = {r.id: r.x for r in TL.running_last(log(spark, rows), line, F.col("v"), "x", current=False).collect()}
        total, last, want_sum, want_last = Counter(), {}, {}, {}
        for k, _, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
            want_last[i] = last.get(k)
            total[k] += v or 0
            want_sum[i] = total[k]
            last[k] = last.get(k) if v is None else v
        assert sums == want_sum and lasts == want_last


def test_empty_log(spark):
    empty = log(spark, [])
    line = TL.Timeline(["k"], ["ts", "id"])
    assert TL.running_sum(empty, line, F.col("v"), "s").collect() == []
