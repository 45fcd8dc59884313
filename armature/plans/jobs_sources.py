"""Sources, sinks and catalog jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from armature.functions import vectors as V
from armature.functions.chance import uniform
from armature.operators import episodes as E
from armature.operators import mixtures as M
from armature.operators import growing, motion, ordering, statcache, statistics
from armature.operators.smallside import pin_small
from armature.plans import views as W
from armature.plans.registry import job, r6, sql_r6, sql_wide, text_of, wide
from armature.sources import catalog, sinks, tables

ACTIONS = [f"a{i}" for i in range(7)]
STATES = [f"s{i}" for i in range(8)]


@job(
    "episode_source",
    W.sql("v_steps", f"SELECT dataset_name, episode_id, timestep, language_instruction, {sql_wide(ACTIONS, 'a')} FROM v_steps WHERE dataset_name = 'ds_a'"),
)
def episode_source(spark, d):
    path = sinks.scratch(spark, "steps")
    sinks.write_demos(W.steps(spark, d), path)
    one = tables.episodes(spark, path, "ds_a")
    return one.select("dataset_name", "episode_id", "timestep", "language_instruction", *wide("action", "a", 7))


@job(
    "split_episodes",
    W.sql(
        "v_steps",
        """SELECT s.dataset_name, s.episode_id, s.event_id, CASE WHEN s.dataset_name = 'ds_c' THEN CASE WHEN s.episode_id % 4 = 0 THEN 'val' ELSE 'train' END
          WHEN e.idx < floor(e.n * 95 / 100e0 + 5e-1) THEN 'train' ELSE 'val' END AS split
        FROM v_steps s JOIN e ON s.episode_id = e.episode_id""",
        e="""SELECT dataset_name, episode_id, row_number() OVER (PARTITION BY dataset_name ORDER BY episode_id) - 1 AS idx,
             count(*) OVER (PARTITION BY dataset_name) AS n FROM (SELECT DISTINCT dataset_name, episode_id FROM v_steps)""",
    ),
)
def split_episodes(spark, d):
    """Dataset ds_c comes with a validation split of its own; the others are cut."""
    own = F.when((F.col("dataset_name") == "ds_c") & (F.col("episode_id") % 4 == 0), "val").otherwise("train")
    steps = W.step_rows(spark, d).withColumn("stored", own)
    return M.split_by_episode(steps, 95, stored="stored").select("dataset_name", "episode_id", "event_id", "split")


#: The arrays of the supplied tables are small: a range of a quarter megabyte still cuts them.
ARRAY_RANGE = 1 << 18


@job(
    "chat_source",
    W.sql("v_turns", 'SELECT CAST(conv_id AS VARCHAR) AS id, image, turn_idx, role AS "from", text AS "value" FROM v_turns'),
)
def chat_source(spark, d):
    """Examples written as JSON arrays and read back by byte ranges."""
    path = sinks.scratch(spark, "chat")
    said = W.turns(spark, d).select("conv_id", "image", "turn_idx", F.col("role").alias("from"), F.col("text").alias("value"))
    parts = E.in_parts(said, ["from", "value"], ["conv_id", "image"], "turn_idx")
    examples = parts.select(
        "conv_id",
        F.col("conv_id").cast("string").alias("id"),
        "part",
        "image",
        F.transform("steps", lambda s: F.struct(s["from"].alias("from"), s["value"].alias("value"))).alias("conversations"),
    )
    numbered = ordering.with_random_position(examples, [], ["conv_id", "part"], 5).drop("conv_id")
    sinks.write_json_arrays(numbered, path, 100_000)
    read = tables.chat_examples(spark, path, range_bytes=ARRAY_RANGE)
    return read.select("id", "part", "image", F.posexplode("conversations").alias("pos", "turn")).select(
        "id",
        "image",
        (F.coalesce("part", F.lit(0)) * 1024 + F.col("pos")).cast("int").alias("turn_idx"),
        "turn.from",
        "turn.value",
    )


def _long(view: str, name: str, proprio: list[str]) -> str:
    pieces = [f"SELECT dataset_name, 'action' AS key, {i} AS dim, a{i} AS value FROM {view}" for i in range(7)]
    pieces += [f"SELECT dataset_name, 'proprio' AS key, {i} AS dim, {p} AS value FROM {view}" for i, p in enumerate(proprio)]
    return " UNION ALL ".join(pieces)


LONG_STEPS = _long("v_steps", "long", STATES)
STATS_SQL = """SELECT dataset_name, key, CAST(dim AS INT) AS dim, avg(value) AS mean, stddev_pop(value) AS std, min(value) AS min, max(value) AS max,
  quantile_cont(value, 0.01) AS q01, quantile_cont(value, 0.99) AS q99 FROM long GROUP BY ALL"""
STAT_COLUMNS = ", ".join(sql_r6(s, s) for s in ("mean", "std", "min", "max", "q01", "q99"))


def exploded(stats):
    """Wide per-dataset statistics -> rounded (dataset, key, dim) rows."""
    numbers = lambda k: F.struct(*[F.col(k)[n].alias(n) for n in statistics.STATISTICS])
    keyed = F.explode(F.array(*[F.struct(F.lit(k).alias("key"), numbers(k).alias("s")) for k in ("action", "proprio")]))
    zipped = F.posexplode(F.arrays_zip(*[F.col(f"s.{n}").alias(n) for n in statistics.STATISTICS]))
    return (
        stats.select("dataset_name", keyed.alias("k"))
        .select("dataset_name", "k.key", "k.s")
        .select("dataset_name", "key", zipped.alias("dim", "z"))
        .select("dataset_name", "key", "dim", *[r6(f"z.{n}").alias(n) for n in statistics.STATISTICS])
    )


def with_state(spark, d):
    return W.step_rows(spark, d).withColumnRenamed("state", "proprio")


@job("stats_source", W.sql("v_steps", f"SELECT dataset_name, key, dim, {STAT_COLUMNS} FROM st", long=LONG_STEPS, st=STATS_SQL))
def stats_source(spark, d):
    path = sinks.scratch(spark, "stats") + "/dataset_statistics.json"
    sinks.write_statistics(statistics.dataset_statistics(with_state(spark, d)), path)
    return exploded(tables.saved_statistics(spark, path))


@job(
    "stats_sink",
    W.sql(
        "v_steps",
        f"""SELECT dataset_name, key, dim, num_transitions, num_trajectories, {STAT_COLUMNS} FROM st JOIN
        (SELECT dataset_name, count(*) AS num_transitions, count(DISTINCT episode_id) AS num_trajectories FROM v_steps GROUP BY 1) n USING (dataset_name)""",
        long=LONG_STEPS,
        st=STATS_SQL,
    ),
)
def stats_sink(spark, d):
    path = sinks.scratch(spark, "stats") + ".json"
    stats = statistics.dataset_statistics(with_state(spark, d))
    sinks.write_statistics(stats, path)
    back = tables.saved_statistics(spark, path)
    return exploded(back).join(back.select("dataset_name", "num_transitions", "num_trajectories"), "dataset_name")


@job(
    "stats_cache",
    W.sql(
        "v_steps",
        f"""SELECT dataset_name, sha256(dataset_name || '|' || 'state' || '|' || 'as_is') AS cache_key, dataset_name = 'ds_a' AS was_cached,
        count(*) AS num_transitions, {sql_r6("quantile_cont(a0, 0.99)", "a0_q99")} FROM v_steps GROUP BY dataset_name""",
    ),
)
def stats_cache(spark, d):
    path = sinks.scratch(spark, "stats-cache")
    steps = with_state(spark, d)
    statcache.statistics_with_cache(steps.filter("dataset_name = 'ds_a'"), path, "state", "as_is")
    found = statcache.statistics_with_cache(steps, path, "state", "as_is")
    return found.select("dataset_name", "cache_key", "was_cached", "num_transitions", r6(F.col("action.q99")[0]).alias("a0_q99"))


@job(
    "stats_growing",
    W.sql(
        "v_steps",
        f"""SELECT dataset_name, key, dim, num_transitions, num_trajectories, {', '.join(sql_r6(s, s) for s in ('mean', 'std', 'min', 'max'))},
        TRUE AS q01_in_bounds, TRUE AS q99_in_bounds FROM st JOIN
        (SELECT dataset_name, count(*) AS num_transitions, count(DISTINCT episode_id) AS num_trajectories FROM v_steps GROUP BY 1) n USING (dataset_name)""",
        long=LONG_STEPS,
        st=STATS_SQL,
    ),
)
def stats_growing(spark, d):
    """Three batches of new episodes, one of them added twice; ranks are checked against all rows."""
    path = sinks.scratch(spark, "stats-growing")
    steps = W.steps(spark, d).withColumnRenamed("state", "proprio")
    for batch in (0, 1, 2, 1):
        growing.add_episodes(steps.filter(F.floor(F.col("episode_id") / 3) % 3 == batch), path, str(batch), {"action": 7, "proprio": 8})
    found = growing.grown_statistics(spark, path).drop("n", "sketch")
    ranks = statistics.quantile_ranks(statistics.long_values(with_state(spark, d)), found, round(1 / growing.RANK_SLACK))
    numbers = [r6(c).alias(c) for c in ("mean", "std", "min", "max")]
    return ranks.join(growing.grown_sizes(spark, path), "dataset_name").select(
        "dataset_name", "key", "dim", "num_transitions", "num_trajectories", *numbers, "q01_in_bounds", "q99_in_bounds"
    )


NOOP_SQL = """SELECT *, sm AND NOT coalesce(start_t < timestep AND grip <> before, FALSE) AS is_noop FROM (
  SELECT *, sqrt(a0 * a0 + a1 * a1) < 1e-4 AS sm, lag(grip) OVER w AS before,
    min(CASE WHEN sqrt(a0 * a0 + a1 * a1) >= 1e-4 THEN timestep END) OVER (PARTITION BY episode_id) AS start_t
  FROM v_noop WINDOW w AS (PARTITION BY episode_id ORDER BY timestep))"""


def noop_marked(spark, d):
    small = F.sqrt(F.col("a0") * F.col("a0") + F.col("a1") * F.col("a1")) < 1e-4
    return motion.mark_noops(W.noop_steps(spark, d), small, "grip")


@job(
    "demo_table_source_sink",
    W.sql(
        "v_noop",
        f"""SELECT k.dataset_name, k.episode_id, timestep, demo_step, {sql_r6("a0", "a0")}, {sql_r6("a1", "a1")}, grip,
          CASE WHEN demo_step = max(demo_step) OVER (PARTITION BY k.episode_id) THEN 1 ELSE 0 END AS done,
          CASE WHEN demo_step = max(demo_step) OVER (PARTITION BY k.episode_id) THEN 1 ELSE 0 END AS reward
        FROM (SELECT *, CAST(row_number() OVER (PARTITION BY episode_id ORDER BY timestep) - 1 AS INT) AS demo_step FROM m WHERE NOT is_noop) k
        WHERE k.episode_id IN (SELECT episode_id FROM v_noop GROUP BY 1 HAVING arg_max(grip, timestep) > 0)""",
        m=NOOP_SQL,
    ),
)
def demo_table_source_sink(spark, d):
    path = sinks.scratch(spark, "demos")
    marked = noop_marked(spark, d)
    # success is decided by the last step of the replay, before no-ops are dropped
    flagged = E.with_episode_facts(marked, {"final_grip": (F.max_by("grip", "timestep"), "last")})
    demos = motion.without_noops(flagged.filter("final_grip > 0").drop("final_grip"))
    ended = E.with_episode_facts(demos, {"last_step": (F.max("demo_step"), "max")})
    last = (F.col("demo_step") == F.col("last_step")).cast("int")
    finished = ended.withColumns({"done": last, "reward": last}).drop("last_step")
    sinks.write_demos(finished, path)
    return tables.episodes(spark, path, schema=finished.schema).select(
        "dataset_name", "episode_id", "timestep", "demo_step", r6("a0").alias("a0"), r6("a1").alias("a1"), "grip", "done", "reward"
    )


@job(
    "episode_metainfo_sink",
    W.sql("v_rollouts", "SELECT replace(task, ' ', '_') AS task_key, concat('demo_', CAST(trial AS VARCHAR)) AS demo, success, n_steps AS initial_state FROM v_rollouts"),
)
def episode_metainfo_sink(spark, d):
    path = sinks.scratch(spark, "metainfo")
    rows = W.rollouts_with_trial(spark, d).select(
        F.replace("task", F.lit(" "), F.lit("_")).alias("task_key"),
        F.concat(F.lit("demo_"), F.col("trial").cast("string")).alias("demo"),
        "success",
        F.col("n_steps").alias("initial_state"),
    )
    sinks.write_episode_metainfo(rows, path)
    return spark.read.schema(rows.schema).json(path).select("task_key", "demo", "success", "initial_state")


@job(
    "rollout_sink",
    W.sql(
        "v_steps",
        """SELECT dataset_name, episode_id, CAST(floor(timestep / 1024) AS BIGINT) AS part, count(*) AS n_steps,
        string_agg(image_primary, ',' ORDER BY timestep) AS images, string_agg(CAST(CAST(s3 AS INT) AS VARCHAR), ',' ORDER BY timestep) AS s3s
        FROM v_steps GROUP BY ALL""",
    ),
)
def rollout_sink(spark, d):
    path = sinks.scratch(spark, "rollouts")
    sinks.write_rollouts(W.steps(spark, d), path, ["image_primary", "state", "action"])
    return spark.read.parquet(path).select(
        "dataset_name",
        "episode_id",
        "part",
        F.size("steps").cast("long").alias("n_steps"),
        F.array_join(F.col("steps.image_primary"), ",").alias("images"),
        text_of(F.transform("steps.state", lambda s: s[3].cast("int"))).alias("s3s"),
    )


@job(
    "metrics_log_source_sink",
    W.sql("v_metrics", f"SELECT run_id, batch_idx, {sql_r6('loss', 'loss')}, {sql_r6('l1_loss', 'l1_loss')}, {sql_r6('action_accuracy', 'action_accuracy')} FROM v_metrics"),
)
def metrics_log_source_sink(spark, d):
    path, header = sinks.scratch(spark, "metrics"), sinks.scratch(spark, "hparams")
    records = W.metrics(spark, d).drop("ts").withColumnRenamed("timestep", "batch_idx")
    runs = records.select("run_id").distinct().withColumn("hparams", F.struct(F.lit(16).alias("batch_size")))
    sinks.append_metrics(records, path, runs, header)
    back = tables.metric_log(spark, path, records.schema)
    return back.select("run_id", "batch_idx", *[r6(c).alias(c) for c in ("loss", "l1_loss", "action_accuracy")])


#: The supplied datasets under names of the catalog.
CATALOG_NAMES = {"ds_a": "bridge_orig", "ds_b": "fractal20220817_data", "ds_c": "kuka"}


@job(
    "mixture_select",
    W.sql(
        "v_steps",
        """SELECT mixture, s.dataset_name, m.weight, count(*) AS n_steps, count(DISTINCT episode_id) AS n_episodes FROM
        (SELECT * REPLACE (CASE dataset_name """
        + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in CATALOG_NAMES.items())
        + """ END AS dataset_name) FROM v_steps) s
        JOIN (SELECT mixture, dataset_name, arg_min(weight, pos) AS weight FROM named GROUP BY ALL) m USING (dataset_name) GROUP BY ALL""",
        named="SELECT * FROM (VALUES "
        + ", ".join(f"('{name}', {pos}, '{dataset}', {weight}e0)" for name, entries in catalog.mixtures().items() for pos, (dataset, weight) in enumerate(entries))
        + ") t(mixture, pos, dataset_name, weight)",
    ),
)
def mixture_select(spark, d):
    """Every named mixture on the datasets that are there."""
    name = F.col("dataset_name")
    steps = W.step_rows(spark, d).withColumn("dataset_name", F.coalesce(*[F.when(name == a, b) for a, b in CATALOG_NAMES.items()]))
    sizes = pin_small(steps.groupBy("dataset_name").agg(F.count(F.lit(1)).alias("n_steps"), F.countDistinct("episode_id").alias("n_episodes")))
    kept, _ = M.select_mixture(catalog.all_mixtures(spark), sizes, ["mixture"])
    return kept.join(sizes, "dataset_name").select("mixture", "dataset_name", "weight", "n_steps", "n_episodes")


@job(
    "synthetic_source",
    W.sql("v_steps", "SELECT event_id AS id, 'do something spectacular' AS instruction, " + sql_wide([W.draw(11, "event_id", str(i)) for i in range(7)], "a") + " FROM v_steps"),
)
def synthetic_source(spark, d):
    ids = tables.table(spark, d, "events").select(F.col("event_id").alias("id"))
    return M.synthetic_frames(ids, 11).select("id", "instruction", *wide("action", "a", 7))


@job(
    "frame_shards_sink",
    W.sql(
        "v_steps",
        """SELECT CAST(floor(position / 1000) AS BIGINT) AS shard, CAST(1 AS BIGINT) AS n_files, count(*) AS n_rows, min(position) AS first_position,
        max(position) AS last_position, CAST(sum(event_id) AS BIGINT) AS id_sum FROM p GROUP BY 1""",
        p=f"SELECT event_id, row_number() OVER (ORDER BY {W.draw(3, 'event_id')}, event_id) - 1 AS position FROM v_steps",
    ),
)
def frame_shards_sink(spark, d):
    path = sinks.scratch(spark, "shards")
    frames = W.step_rows(spark, d).select("event_id", V.each("action", 7, lambda x, i: x).alias("action"))
    sinks.write_frame_shards(ordering.with_random_position(frames, [], ["event_id"], 3), path, 1000)
    files = sinks.shard_manifest(spark, path).groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("n_rows").alias("n_rows"),
        F.min("first_position").alias("first_position"),
        F.max("last_position").alias("last_position"),
    )
    sums = spark.read.parquet(f"{path}/shards").groupBy(F.col("shard").cast("long").alias("shard")).agg(F.sum("event_id").alias("id_sum"))
    return files.join(sums, "shard")
