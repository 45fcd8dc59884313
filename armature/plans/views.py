"""Stand-in inputs: episodes, chat turns, examples, predictions, rollouts and logs seen in the supplied tables.

Every view exists twice: as a DataFrame (used by the jobs) and as SQL text (used by the oracles).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armature.operators.episodes import add_timestep
from armature.operators.ordering import counter_block, time_block, with_position, with_running_totals
from armature.sources.tables import table

ACTION_DIM = 7
STATE_DIM = 8


def step_values(events: DataFrame) -> DataFrame:
    """Row-wise part of a step: everything but its index."""
    value, event_id = F.col("value"), F.col("event_id")
    kind = F.col("event_type")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    a6 = F.when(kind == "purchase", 1.0).when(kind == "error", 0.0).when(kind == "click", 0.5).when(kind == "view", 0.97)
    lang = F.concat(F.lit("Pick Up Item "), (F.col("user_id") % 10).cast("string"))
    return events.select(
        F.when(F.col("user_id") % 3 == 0, "ds_a").when(F.col("user_id") % 3 == 1, "ds_b").otherwise("ds_c").alias("dataset_name"),
        F.col("user_id").alias("episode_id"),
        "event_id",
        "ts",
        F.array(
            value / 1e2 - 0.2,
            (F.hour("ts") - 11.5) / 12.0,
            (F.minute("ts") - 29.5) / 30.0,
            (k - 50.0) / 50.0,
            value * (event_id % 7 - 3) / 1e2,
            F.lit(0.0),
            a6.otherwise(0.3),
        ).alias("action"),
        F.array(
            value,
            F.hour("ts") * 1.0,
            F.minute("ts") * 1.0,
            (event_id % 11) * 1.0,
            (event_id % 13) * 1.0,
            (event_id % 17) * 1.0,
            F.lit(0.0),
            (event_id % 2) * 1.0,
        ).alias("state"),
        F.when(kind == "purchase", -1.0).when(kind == "error", 1.0).when(kind == "view", 0.05).otherwise(0.0).alias("grip_rel"),
        F.when((F.col("user_id") % 5 == 0) | (event_id % 4 == 0), "").otherwise(lang).alias("language_instruction"),
        F.when(event_id % 6 == 0, "").otherwise(F.concat(F.lit("img_"), event_id.cast("string"))).alias("image_primary"),
    )


def step_rows(spark: SparkSession, d: str) -> DataFrame:
    """Steps without their index, for jobs that never look at order: no shuffle at all."""
    return step_values(table(spark, d, "events"))


def steps(spark: SparkSession, d: str) -> DataFrame:
    """One episode per user, in time order."""
    return add_timestep(step_rows(spark, d), ["dataset_name", "episode_id"], ["ts", "event_id"])


def short_steps(spark: SparkSession, d: str) -> DataFrame:
    """Episodes of one user and day: lengths 1 to 10."""
    daily = step_rows(spark, d).withColumn("day", F.to_date("ts"))
    return add_timestep(daily, ["dataset_name", "episode_id", "day"], ["ts", "event_id"])


def noop_steps(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    return steps(spark, d).select(
        "dataset_name", "episode_id", "timestep",
        F.when(e % 3 == 0, F.col("action")[0]).otherwise(0.0).alias("a0"),
        F.when(e % 3 == 1, 5e-5).otherwise(0.0).alias("a1"),
        F.when(F.col("action")[6] > 0.6, 1.0).otherwise(-1.0).alias("grip"),
    )


def mixture(spark: SparkSession) -> DataFrame:
    rows = [(0, "ds_a", 1.0), (1, "ds_b", 0.5), (2, "ds_c", 2.0), (3, "ds_a", 9.0)]
    return spark.createDataFrame(rows, "pos int, dataset_name string, weight double")


def turns_of(said: DataFrame) -> DataFrame:
    """(conv_id, turn_idx, role, text): what system turns say opens the next turn of somebody else.

    System turns with nothing after them are a last turn of the human side, so a conversation of system turns only is one
    turn. A null role counts as the model's, a null text as empty, a null turn number comes first; equal numbers go by role
    and text. Rows without a conv_id belong to no conversation and are left out.
    """
    spoken = ~F.col("role").eqNullSafe("system")
    block = F.coalesce(counter_block(F.col("turn"), 1024), F.lit(-(1 << 62)))
    counts = {"__nth": F.lit(1), "__spoken": spoken.cast("long")}
    rows = with_running_totals(said.select("conv_id", "turn", "role", "text"), ["conv_id"], ["turn", "role", "text"], block, counts)
    piece = F.struct("__nth", F.coalesce("text", F.lit("")).alias("text"))
    whose = F.max(F.when(spoken, F.when(F.col("role") == "user", "human").otherwise("gpt")))
    return rows.groupBy("conv_id", (F.col("__spoken") - spoken.cast("long")).cast("int").alias("turn_idx")).agg(
        F.coalesce(whose, F.lit("human")).alias("role"),
        F.array_join(F.sort_array(F.collect_list(piece)).getField("text"), "\n").alias("text"),
    )


def turns(spark: SparkSession, d: str) -> DataFrame:
    image = F.when(F.col("conv_id") % 3 == 0, None).otherwise(F.concat(F.col("conv_id").cast("string"), F.lit(".jpg")))
    return turns_of(table(spark, d, "conversations")).withColumn("image", image)


def examples(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels").select("doc_id", F.lit(True).alias("labeled"))
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("example_id"),
        F.col("lang").alias("source"),
        F.col("labeled").isNotNull().alias("is_multimodal"),
        (1 + F.floor(F.col("n_chars") / 6.0)).cast("long").alias("n_words"),
    )


def qa(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(
        (F.col("doc_id") % 400).alias("image_id"),
        F.concat(F.lit("  "), F.substring_index("text", "\n", 1)).alias("question"),
        F.expr("substring(text, length(substring_index(text, '\\n', 1)) + 1)").alias("answer"),
        "doc_id",
    )


def predictions(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    off = F.when(e % 4 == 0, e % 3 - 1).otherwise(0)
    return step_rows(spark, d).select(
        "dataset_name",
        F.floor(e / 64.0).cast("long").alias("step"),
        e.alias("sample_id"),
        (1 + e % 256).cast("int").alias("gt_bin"),
        F.greatest(F.lit(1), F.least(F.lit(256), 1 + e % 256 + off)).cast("int").alias("pred_bin"),
    )


def rollout_values(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderpriority").alias("task"),
        F.col("o_orderkey").alias("run_order"),
        (F.col("o_orderstatus") == "F").alias("success"),
        (F.col("o_orderkey") % 300).cast("int").alias("n_steps"),
    )


def rollouts(spark: SparkSession, d: str) -> DataFrame:
    return rollout_values(table(spark, d, "orders"))


def rollouts_with_trial(spark: SparkSession, d: str) -> DataFrame:
    rows = rollouts(spark, d)
    numbered = with_position(rows, ["task"], ["run_order"], name="trial")
    return numbered.withColumn("trial", F.col("trial").cast("int"))


def metric_values(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat(F.lit("run_"), (F.col("user_id") % 3).cast("string")).alias("run_id"),
        "event_id",
        "ts",
        F.col("value").alias("loss"),
        (F.col("value") / 1e3).alias("l1_loss"),
        ((F.col("event_id") % 100) / 1e2).alias("action_accuracy"),
        ((F.col("event_id") % 10 + 1) * 2e-5).alias("lr"),
    )


def metric_rows(spark: SparkSession, d: str) -> DataFrame:
    return metric_values(table(spark, d, "events"))


def metrics(spark: SparkSession, d: str) -> DataFrame:
    """One log per run, `timestep` = batch index."""
    rows = metric_rows(spark, d)
    return add_timestep(rows, ["run_id"], ["ts", "event_id"], time_block(F.col("ts"), 60)).drop("event_id")


SQL = {
    "v_steps": """
SELECT CASE user_id % 3 WHEN 0 THEN 'ds_a' WHEN 1 THEN 'ds_b' ELSE 'ds_c' END AS dataset_name,
       user_id AS episode_id,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INT) AS timestep,
       event_id, ts,
       value / 1e2 - 2e-1 AS a0, (hour(ts) - 11.5e0) / 12e0 AS a1, (minute(ts) - 29.5e0) / 30e0 AS a2,
       (CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) - 50e0) / 50e0 AS a3,
       value * (event_id % 7 - 3) / 1e2 AS a4, 0e0 AS a5,
       CASE event_type WHEN 'purchase' THEN 1e0 WHEN 'error' THEN 0e0 WHEN 'click' THEN 5e-1 WHEN 'view' THEN 9.7e-1 ELSE 3e-1 END AS a6,
       CASE event_type WHEN 'purchase' THEN -1e0 WHEN 'error' THEN 1e0 WHEN 'view' THEN 5e-2 ELSE 0e0 END AS grip_rel,
       value AS s0, hour(ts) * 1e0 AS s1, minute(ts) * 1e0 AS s2, (event_id % 11) * 1e0 AS s3, (event_id % 13) * 1e0 AS s4,
       (event_id % 17) * 1e0 AS s5, 0e0 AS s6, (event_id % 2) * 1e0 AS s7,
       CASE WHEN user_id % 5 = 0 OR event_id % 4 = 0 THEN '' ELSE concat('Pick Up Item ', CAST(user_id % 10 AS STRING)) END AS language_instruction,
       CASE WHEN event_id % 6 = 0 THEN '' ELSE concat('img_', CAST(event_id AS STRING)) END AS image_primary
FROM events""",
    "v_short": """
SELECT * REPLACE (CAST(row_number() OVER (PARTITION BY episode_id, CAST(ts AS DATE) ORDER BY ts, event_id) - 1 AS INT) AS timestep),
       CAST(ts AS DATE) AS day
FROM v_steps""",
    "v_noop": """
SELECT dataset_name, episode_id, timestep,
       CASE WHEN event_id % 3 = 0 THEN a0 ELSE 0e0 END AS a0, CASE WHEN event_id % 3 = 1 THEN 5e-5 ELSE 0e0 END AS a1,
       CASE WHEN a6 > 6e-1 THEN 1e0 ELSE -1e0 END AS grip
FROM v_steps""",
    "v_mixture": """
SELECT * FROM (VALUES (0, 'ds_a', 1e0), (1, 'ds_b', 5e-1), (2, 'ds_c', 2e0), (3, 'ds_a', 9e0)) t(pos, dataset_name, weight)""",
    "v_turns": """
SELECT conv_id, turn_idx, CASE max(CASE WHEN role = 'system' THEN 0 WHEN role = 'user' THEN 1 ELSE 2 END) WHEN 2 THEN 'gpt' ELSE 'human' END AS role,
       string_agg(coalesce(text, ''), chr(10) ORDER BY nth) AS text, CASE WHEN conv_id % 3 = 0 THEN NULL ELSE concat(CAST(conv_id AS STRING), '.jpg') END AS image
FROM (SELECT *, row_number() OVER w AS nth,
             CAST(sum(CASE WHEN role IS DISTINCT FROM 'system' THEN 1 ELSE 0 END) OVER w - CASE WHEN role IS DISTINCT FROM 'system' THEN 1 ELSE 0 END AS INT) AS turn_idx
      FROM conversations WHERE conv_id IS NOT NULL
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
GROUP BY conv_id, turn_idx""",
    "v_examples": """
SELECT d.doc_id AS example_id, d.lang AS source, l.doc_id IS NOT NULL AS is_multimodal,
       CAST(1 + floor(d.n_chars / 6e0) AS BIGINT) AS n_words
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "v_qa": """
SELECT doc_id % 400 AS image_id, concat('  ', split_part(text, chr(10), 1)) AS question, substr(text, length(split_part(text, chr(10), 1)) + 1) AS answer, doc_id FROM documents""",
    "v_preds": """
SELECT dataset_name, CAST(floor(event_id / 64e0) AS BIGINT) AS step, event_id AS sample_id,
       CAST(1 + event_id % 256 AS INT) AS gt_bin,
       CAST(greatest(1, least(256, 1 + event_id % 256 + CASE WHEN event_id % 4 = 0 THEN event_id % 3 - 1 ELSE 0 END)) AS INT) AS pred_bin
FROM v_steps""",
    "v_rollouts": """
SELECT o_orderpriority AS task, o_orderkey AS run_order,
       CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS INT) AS trial,
       o_orderstatus = 'F' AS success, CAST(o_orderkey % 300 AS INT) AS n_steps
FROM orders""",
    "v_metrics": """
SELECT concat('run_', CAST(user_id % 3 AS STRING)) AS run_id,
       CAST(row_number() OVER (PARTITION BY user_id % 3 ORDER BY ts, event_id) - 1 AS INT) AS batch_idx,
       ts, value AS loss, value / 1e3 AS l1_loss, (event_id % 100) / 1e2 AS action_accuracy, (event_id % 10 + 1) * 2e-5 AS lr
FROM events""",
}
NEEDS = {"v_short": ["v_steps"], "v_noop": ["v_steps"], "v_preds": ["v_steps"]}


def sql(view: str, body: str, **more: str) -> str:
    """`body` with the view (space-separated names for several) and named subqueries as CTEs in front."""
    names: list[str] = []
    for name in view.split():
        names += [n for n in [*NEEDS.get(name, []), name] if n not in names]
    parts = [(n, SQL[n]) for n in names] + list(more.items())
    return "WITH " + ",\n".join(f"{n} AS ({text}\n)" for n, text in parts) + "\n" + body


def draw(seed: int, *keys: str) -> str:
    """SQL text of `uniform`."""
    joined = " || ':' || ".join([f"'{seed}'"] + [f"CAST({k} AS VARCHAR)" for k in keys])
    return f"(CAST(('0x' || substr(md5({joined}), 1, 13)) AS BIGINT) / 4503599627370496e0)"
