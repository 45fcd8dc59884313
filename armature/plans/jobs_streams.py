"""Streaming jobs, each run over what is there and read back from its sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from armature.operators import gating
from armature.operators import statistics as T
from armature.operators.smallside import pin_small
from armature.plans import views as W
from armature.plans.jobs_evaluation import ROLLED_SQL, SMOOTH
from armature.plans.jobs_sources import ACTIONS
from armature.plans.jobs_tokens import example_ctes, labels_sql
from armature.plans.jobs_trajectories import GRIPPER_MASK, WIDE_STATS, normalized_sql
from armature.plans.registry import job, r6, text_of
from armature.sources import sinks, tables
from armature.streaming import ordered as O
from armature.streaming import streams as S

#: How long events are waited for, in seconds.
DELAY = 86_400


def arriving(spark, d, name):
    return S.file_stream(spark, d, tables.table(spark, d, name).schema, f"{name}.parquet")


@job(
    "stream_frames",
    W.sql(
        "v_steps",
        f"SELECT event_id, dataset_name, image_primary AS image, array_to_string(input_ids, ',') AS input_ids, array_to_string({labels_sql(8, True)}, ',') AS labels FROM ids",
        st=WIDE_STATS,
        f=f"SELECT dataset_name, event_id, language_instruction, image_primary, {', '.join(f'''{normalized_sql(c, 'bounds_q99')} AS {c}''' for c in ACTIONS)} FROM v_steps JOIN st USING (dataset_name)",
        **example_ctes("f", ACTIONS),
    ),
)
def stream_frames(spark, d):
    static = W.step_rows(spark, d).withColumnRenamed("state", "proprio")
    stats = pin_small(T.dataset_statistics(static))
    frames = S.token_frames(W.step_values(arriving(spark, d, "events")), stats, "bounds_q99", 7, GRIPPER_MASK, ["event_id"])
    path = sinks.scratch(spark, "stream-frames")
    S.run_to_end(frames, S.append_batches(path))
    out = spark.read.parquet(path)
    return out.select(
        "event_id", "dataset_name", "image", text_of(F.col("input_ids")).alias("input_ids"), text_of(F.col("labels")).alias("labels")
    )


@job("stream_metrics", ROLLED_SQL)
def stream_metrics(spark, d):
    log = W.metric_values(arriving(spark, d, "events")).withColumn("at_us", F.unix_micros(F.col("ts").cast("timestamp")))
    log = log.withColumn("timestep", F.lit(None).cast("long"))
    fields = W.metric_rows(spark, d).schema
    sink = O.InOrder(spark, sinks.scratch(spark, "stream-metrics"), O.rolling(fields, 20, 4, delay_seconds=DELAY))
    S.run_to_end(log, sink.write)
    return sink.answer().select("run_id", F.col("timestep").cast("int").alias("batch_idx"), *[r6(c, 9).alias(c) for c in SMOOTH])


@job("stream_success", W.sql("v_rollouts", "SELECT task, count(*) AS n_episodes, CAST(sum(CASE WHEN success THEN 1 ELSE 0 END) AS BIGINT) AS n_successes FROM v_rollouts GROUP BY 1"))
def stream_success(spark, d):
    path = sinks.scratch(spark, "stream-success")
    S.run_to_end(S.success_counters(W.rollout_values(arriving(spark, d, "orders"))), S.append_batches(path), "update")
    return S.newest(spark.read.parquet(path), ["task"])


#: One event per four hours and key, the density of the supplied table.
GATE_HERTZ = 1.0 / 14_400


def ticks(events):
    return events.select("user_id", "event_id", F.col("ts").cast("timestamp").alias("at"))


GATE_SQL = """WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts) AS at_us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
  nxt AS (SELECT a.user_id, a.i, min(b.i) AS j FROM e a JOIN e b ON a.user_id = b.user_id AND b.at_us > a.at_us + 14400000000 GROUP BY ALL),
  walk AS (SELECT user_id, CAST(1 AS BIGINT) AS i FROM e WHERE i = 1 UNION ALL SELECT w.user_id, n.j FROM walk w JOIN nxt n ON w.user_id = n.user_id AND w.i = n.i)
  SELECT user_id, event_id, at_us FROM walk JOIN e USING (user_id, i)"""


@job("rate_gate", GATE_SQL)
def rate_gate(spark, d):
    return gating.rate_gate(ticks(tables.table(spark, d, "events")), "user_id", GATE_HERTZ, slot_seconds=5 * 86_400)


@job("stream_rate_gate", GATE_SQL)
def stream_rate_gate(spark, d):
    key = tables.table(spark, d, "events").schema["user_id"]
    order = O.gate(key, GATE_HERTZ, delay_seconds=DELAY, slot_seconds=5 * 86_400)
    sink = O.InOrder(spark, sinks.scratch(spark, "stream-gate"), order)
    S.run_to_end(ticks(arriving(spark, d, "events")).withColumn("at_us", F.unix_micros("at")), sink.write)
    return sink.answer()
