"""Metric and evaluation jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from armature.functions import actions as A
from armature.functions import text
from armature.operators import evaluation as V
from armature.plans import views as W
from armature.plans.jobs_sources import NOOP_SQL, noop_marked
from armature.plans.jobs_trajectories import CENTRE
from armature.plans.registry import job, r6, sql_r6
from armature.sources import tables

DISTANCE = f"abs({CENTRE.format(b='pred_bin')} - {CENTRE.format(b='gt_bin')})"
ACCURACY = "avg(CASE WHEN pred_bin = gt_bin THEN 1e0 ELSE 0e0 END)"


def pairs(spark, d):
    """Sequences: an ignored prompt position, one action token, the stop token. Predictions are one position early."""
    preds = W.predictions(spark, d)
    token = lambda c: A.token_of_bin(F.col(c))
    rows = preds.select(
        "dataset_name",
        "step",
        F.array(F.lit(5), token("pred_bin"), F.lit(2), F.lit(0)).alias("pred_ids"),
        F.array(F.lit(A.IGNORE_LABEL), F.lit(A.IGNORE_LABEL), token("gt_bin"), F.lit(2)).alias("labels"),
    )
    return V.token_pairs(rows, ["dataset_name", "step"], "pred_ids", "labels")


@job("action_token_accuracy", W.sql("v_preds", f"SELECT step, count(*) AS n_tokens, {sql_r6(ACCURACY, 'action_accuracy')} FROM v_preds GROUP BY 1"))
def action_token_accuracy(spark, d):
    return V.token_metrics(pairs(spark, d), ["step"]).select("step", "n_tokens", r6("action_accuracy").alias("action_accuracy"))


@job("action_l1", W.sql("v_preds", f"SELECT step, {sql_r6(f'avg({DISTANCE})', 'l1_loss')} FROM v_preds GROUP BY 1"))
def action_l1(spark, d):
    return V.token_metrics(pairs(spark, d), ["step"]).select("step", r6("l1_loss").alias("l1_loss"))


@job(
    "per_dataset_metrics",
    W.sql(
        "v_preds",
        """SELECT dataset_name, step, n_tokens, action_accuracy, l1_loss FROM
        (SELECT *, row_number() OVER (PARTITION BY dataset_name ORDER BY step DESC) AS r FROM
          (SELECT *, count(*) OVER (PARTITION BY step) AS k FROM m) WHERE k > 1) WHERE r = 1""",
        m=f"SELECT dataset_name, step, count(*) AS n_tokens, {sql_r6(ACCURACY, 'action_accuracy')}, {sql_r6(f'avg({DISTANCE})', 'l1_loss')} FROM v_preds GROUP BY ALL",
    ),
)
def per_dataset_metrics(spark, d):
    out = V.dataset_metrics(pairs(spark, d))
    return out.select("dataset_name", "step", "n_tokens", r6("action_accuracy").alias("action_accuracy"), r6("l1_loss").alias("l1_loss"))


def over(expression: str, n: int) -> str:
    return f"avg({expression}) OVER (PARTITION BY run_id ORDER BY batch_idx ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


# means of a few decimal values end in exact ties at the sixth digit, hence nine
SMOOTH = ["loss_smooth", "l1_smooth", "accuracy_smooth", "loss_raw", "mean_step_time", "lr"]
#: Batches of an epoch.
EPOCH = 250
ROLLING = f"""SELECT run_id, batch_idx, {over('loss', 20)} AS loss_smooth, {over('l1_loss', 20)} AS l1_smooth, {over('action_accuracy', 20)} AS accuracy_smooth,
  {over('loss', 4)} AS loss_raw, {over('step_time', 20)} AS mean_step_time, lr FROM
  (SELECT *, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY run_id ORDER BY batch_idx)) / 1e6 AS step_time FROM v_metrics)"""


ROLLED_SQL = W.sql("v_metrics", "SELECT run_id, batch_idx, " + ", ".join(sql_r6(c, c, 9) for c in SMOOTH) + " FROM r", r=ROLLING)


@job("rolling_metrics", ROLLED_SQL)
def rolling_metrics(spark, d):
    out = V.rolling_metrics(W.metrics(spark, d), 20, 4)
    return out.select("run_id", F.col("timestep").alias("batch_idx"), *[r6(c, 9).alias(c) for c in SMOOTH])


@job(
    "thin_log",
    W.sql(
        "v_metrics",
        f"""SELECT run_id, g AS grad_step, CAST(floor((g + 1) / 62) AS BIGINT) AS epoch, g > 0 AND g % 100 = 0 AS saves, {sql_r6('arg_max(loss, batch_idx)', 'loss')}, {sql_r6('arg_max(action_accuracy, batch_idx)', 'action_accuracy')}
        FROM (SELECT *, CAST(floor(batch_idx / 4) AS BIGINT) AS g FROM v_metrics) WHERE g % 10 = 0 GROUP BY run_id, g""",
    ),
)
def thin_log(spark, d):
    out = V.thin_log(W.metrics(spark, d), 4, 10, 100, 1000, 16, ["loss", "action_accuracy"])
    return out.withColumns({c: r6(c) for c in ("loss", "action_accuracy")})


@job(
    "metrics_record",
    W.sql(
        "v_metrics v_preds",
        f"""SELECT run_id, CAST(batch_idx AS BIGINT) AS step, 'VLA Train/Loss' AS name, {sql_r6('loss_smooth', 'value', 9)} FROM r
        UNION ALL SELECT run_id, batch_idx, 'VLA Train/L1 Loss', {sql_r6('l1_smooth', 'value', 9)} FROM r
        UNION ALL SELECT run_id, batch_idx, 'VLA Train/Action Token Accuracy', {sql_r6('accuracy_smooth', 'value', 9)} FROM r
        UNION ALL SELECT run_id, batch_idx, 'VLA Train/Loss (Raw)', {sql_r6('loss_raw', 'value', 9)} FROM r
        UNION ALL SELECT run_id, batch_idx, 'VLA Train/Learning Rate', {sql_r6('lr', 'value', 9)} FROM r
        UNION ALL SELECT run_id, batch_idx, 'VLA Train/Step Time', {sql_r6('mean_step_time', 'value', 9)} FROM r
        UNION ALL SELECT run_id, batch_idx, 'VLA Train/Step', CAST(batch_idx AS DOUBLE) FROM r
        UNION ALL SELECT run_id, batch_idx, 'VLA Train/Epoch', floor(batch_idx / {EPOCH}) FROM r
        UNION ALL SELECT 'preds', step, dataset_name || '/L1 Loss', {sql_r6(f'avg({DISTANCE})', 'value')} FROM v_preds GROUP BY step, dataset_name
        UNION ALL SELECT 'preds', step, dataset_name || '/Action Token Accuracy', {sql_r6(ACCURACY, 'value')} FROM v_preds GROUP BY step, dataset_name""",
        r=ROLLING,
    ),
)
def metrics_record(spark, d):
    rolled = V.rolling_metrics(W.metrics(spark, d), 20, 4).withColumn("step", F.col("timestep").cast("long"))
    names = {
        "Loss": "loss_smooth", "L1 Loss": "l1_smooth", "Action Token Accuracy": "accuracy_smooth", "Loss (Raw)": "loss_raw",
        "Learning Rate": "lr", "Step Time": "mean_step_time",
    }
    values = {n: r6(c, 9) for n, c in names.items()} | {"Step": F.col("step"), "Epoch": F.floor(F.col("step") / EPOCH)}
    train = V.metric_records(rolled, ["run_id", "step"], {f"VLA Train/{n}": v for n, v in values.items()})
    per_dataset = V.token_metrics(pairs(spark, d), ["step", "dataset_name"]).withColumn("run_id", F.lit("preds"))
    long = V.metric_records(
        per_dataset, ["run_id", "step", "dataset_name"], {"L1 Loss": r6("l1_loss"), "Action Token Accuracy": r6("action_accuracy")}
    )
    named = long.select("run_id", "step", F.concat_ws("/", "dataset_name", "name").alias("name"), "value")
    return train.unionByName(named)


@job(
    "success_rates",
    W.sql("v_rollouts", f"SELECT task, count(*) AS n_episodes, count(*) FILTER (success) AS n_successes, {sql_r6('avg(CASE WHEN success THEN 1e0 ELSE 0e0 END)', 'success_rate')} FROM v_rollouts GROUP BY ROLLUP (task)"),
)
def success_rates(spark, d):
    return V.success_rates(W.rollouts(spark, d)).withColumn("success_rate", r6("success_rate"))


@job(
    "running_success",
    W.sql(
        "v_rollouts",
        f"""SELECT run_order, CAST(e AS BIGINT) AS episodes_so_far, CAST(s AS BIGINT) AS successes_so_far, {sql_r6('s / e * 100', 'success_percent')} FROM
        (SELECT run_order, row_number() OVER (ORDER BY run_order) AS e, sum(CASE WHEN success THEN 1 ELSE 0 END) OVER (ORDER BY run_order) AS s FROM v_rollouts)""",
    ),
)
def running_success(spark, d):
    out = V.running_success(W.rollouts(spark, d))
    return out.select("run_order", "episodes_so_far", "successes_so_far", r6("success_percent").alias("success_percent"))


SUITES = {"1-URGENT": "libero_spatial", "2-HIGH": "libero_object", "3-MEDIUM": "libero_goal", "4-NOT SPECIFIED": "libero_10", "5-LOW": "libero_90"}


@job(
    "episode_step_limit",
    W.sql(
        "v_rollouts",
        """SELECT run_order, lim AS step_limit, CASE WHEN success THEN 'success' WHEN n_steps >= lim THEN 'timeout' ELSE 'aborted' END AS outcome FROM
        (SELECT *, CASE task WHEN '1-URGENT' THEN 230 WHEN '2-HIGH' THEN 290 WHEN '3-MEDIUM' THEN 310 WHEN '4-NOT SPECIFIED' THEN 530 ELSE 410 END AS lim FROM v_rollouts)""",
    ),
)
def episode_step_limit(spark, d):
    suite = F.lit(None).cast("string")
    for task, name in SUITES.items():
        suite = F.when(F.col("task") == task, name).otherwise(suite)
    limited = W.rollouts(spark, d).withColumn("step_limit", V.step_limit(suite))
    return limited.select("run_order", "step_limit", V.outcome(F.col("success"), F.col("n_steps"), F.col("step_limit")).alias("outcome"))


@job(
    "replay_filter_report",
    W.sql(
        "v_noop",
        f"""SELECT count(*) AS n_replays, count(*) FILTER (ok) AS n_successes, {sql_r6('count(*) FILTER (ok) / count(*) * 100', 'success_percent')}, CAST(sum(noops) AS BIGINT) AS n_noops
        FROM (SELECT episode_id, arg_max(grip, timestep) > 0 AS ok, count(*) FILTER (is_noop) AS noops FROM m GROUP BY 1)""",
        m=NOOP_SQL,
    ),
)
def replay_filter_report(spark, d):
    done = F.max_by("grip", "timestep") > 0
    out = V.replay_report(noop_marked(spark, d), ["dataset_name", "episode_id"], done)
    return out.withColumn("success_percent", r6("success_percent"))


@job(
    "throughput",
    W.sql(
        "v_metrics",
        f"SELECT run_id, CAST(sum(batch_idx % 50 + 1) AS BIGINT) AS n_tokens, {sql_r6('(max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6', 'seconds')}, {sql_r6('sum(batch_idx % 50 + 1) / ((max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6)', 'tokens_per_second')} FROM v_metrics GROUP BY 1",
    ),
)
def throughput(spark, d):
    out = V.throughput(W.metrics(spark, d), F.col("timestep") % 50 + 1)
    return out.withColumns({c: r6(c) for c in ("seconds", "tokens_per_second")})


@job("task_slug", "SELECT doc_id, substr(replace(replace(replace(lower(text), ' ', '_'), chr(10), '_'), '.', '_'), 1, 50) AS slug FROM documents")
def task_slug(spark, d):
    return tables.table(spark, d, "documents").select("doc_id", text.task_slug(F.col("text")).alias("slug"))
