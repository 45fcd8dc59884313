"""Streams over several micro-batches, and the rate gate against its loop."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from armature.operators import evaluation, gating
from armature.operators.episodes import add_timestep
from armature.sources import sinks
from armature.streaming import ordered as O
from armature.streaming import streams as S

START = dt.datetime(2024, 1, 1)


def clock(seed, n=300, keys=4):
    """Events of several keys; key 0 has most of them; dense runs and gaps."""
    rnd, now, rows = random.Random(seed), START, []
    for i in range(n):
        now += dt.timedelta(milliseconds=rnd.choice([1, 40, 100, 100, 230, 5000]))
        rows.append((rnd.choice([0] * 5 + list(range(keys))), i, now))
    return rows


def kept(rows, hertz):
    last, out = {}, set()
    for key, i, now in sorted(rows, key=lambda r: (r[2], r[1])):
        if key not in last or now > last[key] + dt.timedelta(seconds=1 / hertz):
            out.add(i)
            last[key] = now
    return out


@pytest.mark.parametrize("slot_seconds", [2, 3600])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_gate_on_tables(spark, seed, slot_seconds):
    rows = clock(seed)
    df = spark.createDataFrame(rows, "key long, event_id long, at timestamp")
    out = gating.rate_gate(df, "key", 5.0, slot_seconds=slot_seconds)
    assert {r["event_id"] for r in out.collect()} == kept(rows, 5.0)


def test_gate_takes_many_short_slots_at_once(spark):
    """Slots go to Python by Arrow batches, not one by one; slots that batches cut, equal times and missing values."""
    rows = [(k, i, now - dt.timedelta(days=40 * 365 * (k % 2) + 20 * 365)) for k, i, now in clock(7, n=600, keys=60)]
    rows += [(k, i + 1000, now) for k, i, now in rows[::7]]
    df = spark.createDataFrame([*rows, (None, 5000, START), (1, 5001, None)], "key long, event_id long, at timestamp")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        out = gating.rate_gate(df, "key", 5.0, slot_seconds=2)
        got = sorted(r["event_id"] for r in out.collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == sorted(kept(rows, 5.0))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan


def arrivals(spark, folder, schema, files):
    """A stream that takes one file per micro-batch, in the order they are given."""
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.02)  # files are taken by their time
    return S.file_stream(spark, folder, spark.read.parquet(folder).schema, "*.parquet", files_per_trigger=1)


TICKS = "key long, event_id long, at timestamp"


def gated(spark, stream, hertz, delay_seconds):
    order = O.gate(T.StructField("key", T.LongType()), hertz, delay_seconds, slot_seconds=60)
    sink = O.InOrder(spark, sinks.scratch(spark, "gate"), order)
    S.run_to_end(stream.withColumn("at_us", F.unix_micros("at")), sink.write)
    return sink


def test_stream_gate_does_not_depend_on_the_order_of_files(spark, tmp_path):
    rows = clock(4)
    mixed = rows[:]
    random.Random(9).shuffle(mixed)
    sink = gated(spark, arrivals(spark, str(tmp_path / "in"), TICKS, [mixed[i : i + 100] for i in (0, 100, 200)]), 5.0, 3600)
    assert {r["event_id"] for r in sink.answer().collect()} == kept(rows, 5.0)
    assert sink.late().count() == 0


def test_stream_gate_over_overlapping_files(spark, tmp_path):
    """Neighbouring files overlap by less than the delay; nothing is late, and most is released before the end."""
    rows = clock(5)
    files = [[r for i, r in enumerate(rows) if min(max(i + (7 * i % 20) - 10, 0), 299) // 100 == n] for n in range(3)]
    sink = gated(spark, arrivals(spark, str(tmp_path / "in"), TICKS, files), 5.0, 120)
    assert {r["event_id"] for r in sink.answer().collect()} == kept(rows, 5.0)
    assert sink.late().count() == 0 and sink.released().count() > len(kept(rows, 5.0)) // 2


def test_late_rows_are_reported_and_silent_keys_forgotten(spark, tmp_path):
    at = lambda s: START + dt.timedelta(seconds=s)
    files = [[(1, 1, at(0)), (2, 2, at(1))], [(2, 3, at(1000)), (2, 4, None), (None, 5, at(1000))], [(1, 6, at(5)), (2, 7, at(1005))]]
    sink = gated(spark, arrivals(spark, str(tmp_path / "in"), TICKS, files), 1.0, 60)
    assert {r["event_id"] for r in sink.answer().collect()} == {1, 2, 3, 7}
    assert {(r["event_id"], r["reason"]) for r in sink.late().collect()} == {(4, O.UNTIMED), (5, O.UNKEYED), (6, O.BEHIND)}
    state = spark.read.option("recursiveFileLookup", True).parquet(f"{sink.path}/state").filter("version = 2")
    assert {(r["kind"], r["event_id"]) for r in state.collect()} == {(O.HELD, 3), (O.HELD, 7), (O.EDGE, None)}


def test_a_micro_batch_that_runs_again_changes_nothing(spark):
    rows = clock(6)
    order = O.gate(T.StructField("key", T.LongType()), 5.0, 30, slot_seconds=60)
    sink = O.InOrder(spark, sinks.scratch(spark, "again"), order)
    for number in (0, 0, 1, 1, 2):
        part = spark.createDataFrame(rows[number * 100 : number * 100 + 100], TICKS)
        sink.write(part.withColumn("at_us", F.unix_micros("at")), number)
    got = [r["event_id"] for r in sink.answer().collect()]
    assert sorted(got) == sorted(kept(rows, 5.0))


LOG = "run_id string, event_id long, ts timestamp, loss double, l1_loss double, action_accuracy double"


def test_stream_of_metrics_equals_the_table(spark, tmp_path):
    rnd = random.Random(3)
    rows = [("ab"[rnd.random() < 0.3], i, START + dt.timedelta(seconds=i), rnd.random(), rnd.random(), rnd.random()) for i in range(120)]
    files = [[r for i, r in enumerate(rows) if min(max(i + (7 * i % 20) - 10, 0), 119) // 40 == n] for n in range(3)]
    stream = arrivals(spark, str(tmp_path / "in"), LOG, files)
    table = spark.createDataFrame(rows, LOG)
    sink = O.InOrder(spark, sinks.scratch(spark, "metrics"), O.rolling(table.schema, 7, 3, delay_seconds=25))
    S.run_to_end(stream.withColumns({"at_us": F.unix_micros("ts"), "timestep": F.lit(None).cast("long")}), sink.write)
    shown = ["run_id", "event_id", "timestep", "loss_smooth", "l1_smooth", "accuracy_smooth", "loss_raw", "mean_step_time"]
    want = evaluation.rolling_metrics(add_timestep(table, ["run_id"], ["ts", "event_id"]), 7, 3)
    near = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(shown).collect())
    assert str(near(sink.answer())) == str(near(want)) and sink.late().count() == 0
    assert sink.released().count() >= 80
    past = spark.read.option("recursiveFileLookup", True).parquet(f"{sink.path}/state").filter("version = 2 AND kind = 'past'")
    assert {r["run_id"]: r["count"] for r in past.groupBy("run_id").count().collect()} == {"a": 7, "b": 7}


def test_counters_and_replayed_batches(spark, tmp_path):
    source, path = str(tmp_path / "in"), sinks.scratch(spark, "success")
    for i in range(3):
        spark.createDataFrame([("a", i % 2 == 0), ("b", True)], "task string, success boolean").write.mode("append").parquet(source)
    stream = S.file_stream(spark, source, spark.read.parquet(source).schema, "*.parquet", 1)
    S.run_to_end(S.success_counters(stream), S.append_batches(path), "update")
    got = {r["task"]: (r["n_episodes"], r["n_successes"]) for r in S.newest(spark.read.parquet(path), ["task"]).collect()}
    assert got == {"a": (3, 2), "b": (3, 3)}
    twice = sinks.scratch(spark, "twice")
    for _ in range(2):  # a micro-batch that is run again replaces itself
        S.append_batches(twice)(spark.range(3), 0)
    assert spark.read.parquet(twice).count() == 3
