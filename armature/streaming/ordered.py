"""Streams whose answers depend on time order, though files come in any order.

Rows wait until the watermark has passed them: the latest time seen so far, less a delay. Each micro-batch then releases what
is due to an operator on tables, together with the few earlier rows that the operator still needs, so a key that holds a large
share of the stream is cut up inside a micro-batch as it is on tables. A row that comes behind the watermark goes to a side
table with the reason.

What waits and what is still needed is a table in shared storage with two versions. Micro-batch n reads version n - 1 and
writes version n: one that is run again finds the same state and replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from armature.operators import evaluation, gating
from armature.operators.ordering import time_block, with_position

#: Rows of the state: waiting for the watermark, needed by later rows, and the watermark itself.
HELD, PAST, EDGE = "held", "past", "edge"
BEHIND, UNTIMED, UNKEYED = "behind the watermark", "no time", "no key"
#: Later than any time.
NEVER = (1 << 63) - 1


@dataclass(frozen=True)
class Order:
    """What to do with rows that are due.

    `release(due, past)` gives the answer for the rows of `due`; `past` holds earlier rows in the same columns. `remember(due,
    past, answer, edge)` gives the rows that later ones need; `edge` is the new watermark in microseconds. The columns are
    those of `schema`, with the event time as `at_us`.
    """

    schema: T.StructType
    key: str
    release: Callable[[DataFrame, DataFrame], DataFrame]
    remember: Callable[[DataFrame, DataFrame, DataFrame, int], DataFrame]
    delay_us: int


class InOrder:
    """A sink for `run_to_end`: answers in `path`/out, late rows in `path`/late."""

    def __init__(self, spark: SparkSession, path: str, order: Order):
        self.spark, self.path, self.order = spark, path, order
        self.state_schema = T.StructType([T.StructField("kind", T.StringType()), T.StructField("version", T.LongType()), *order.schema.fields])

    def _version(self, number: int) -> DataFrame:
        """The state that micro-batch `number` left behind."""
        if number < 0:
            return self.spark.createDataFrame([], self.state_schema)
        return self.spark.read.schema(self.state_schema).parquet(f"{self.path}/state/{number % 2}")

    @staticmethod
    def _edge(state: DataFrame) -> int | None:
        return state.filter(F.col("kind") == EDGE).agg(F.max("at_us")).first()[0]

    def _rows(self, state: DataFrame, kind: str) -> DataFrame:
        return state.filter(F.col("kind") == kind).select(*self.order.schema.names)

    def write(self, batch: DataFrame, number: int) -> None:
        names = self.order.schema.names
        state = self._version(number - 1)
        edge = self._edge(state)
        arrived = batch.select(*names).persist()
        latest = arrived.agg(F.max("at_us")).first()[0]
        ends = [e for e in (edge, None if latest is None else latest - self.order.delay_us) if e is not None]
        now = max(ends) if ends else -NEVER
        behind = F.lit(False) if edge is None else F.col("at_us") <= edge
        reason = F.when(F.col("at_us").isNull(), UNTIMED).when(F.col(self.order.key).isNull(), UNKEYED).when(behind, BEHIND)
        rows = arrived.withColumn("reason", reason)
        rows.filter("reason IS NOT NULL").write.mode("overwrite").parquet(f"{self.path}/late/batch={number}")

        pool = self._rows(state, HELD).unionByName(rows.filter("reason IS NULL").drop("reason"))
        due, past = pool.filter(F.col("at_us") <= now), self._rows(state, PAST)
        out = f"{self.path}/out/batch={number}"
        self.order.release(due, past).write.mode("overwrite").parquet(out)
        kept = self.order.remember(due, past, self.spark.read.parquet(out), now)
        line = self.spark.range(1).select(F.lit(now).alias("at_us"))
        following = (
            pool.filter(F.col("at_us") > now).withColumn("kind", F.lit(HELD))
            .unionByName(kept.withColumn("kind", F.lit(PAST)))
            .unionByName(line.withColumn("kind", F.lit(EDGE)), allowMissingColumns=True)
        )
        following.withColumn("version", F.lit(number).cast("long")).select(*self.state_schema.names).write.mode("overwrite").parquet(
            f"{self.path}/state/{number % 2}"
        )
        arrived.unpersist()

    def released(self) -> DataFrame:
        """Answers for all rows that the watermark has passed."""
        return self.spark.read.parquet(f"{self.path}/out").drop("batch")

    def late(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/late").drop("batch")

    def waiting(self) -> DataFrame:
        """Answers for the rows that still wait, as if the stream ended here. Nothing is written: it may go on."""
        versions = self.spark.read.schema(self.state_schema).option("recursiveFileLookup", True).parquet(f"{self.path}/state")
        state = self._version(versions.agg(F.max("version")).first()[0])
        return self.order.release(self._rows(state, HELD), self._rows(state, PAST))

    def answer(self) -> DataFrame:
        """Everything that came in time, of a stream that has ended."""
        return self.released().unionByName(self.waiting())


def gate(key: T.StructField, hertz: float, delay_seconds: int, slot_seconds: int = 3600) -> Order:
    """Thin each key's events to a control frequency, in time order: the answers of `gating.rate_gate`.

    The last event of a key that passed is needed for one step; after that the next one passes whatever came before, so keys
    that fall silent leave the state. Columns: the key, event_id, at_us.
    """
    step = int(round(1e6 / hertz))
    schema = T.StructType([key, T.StructField("event_id", T.LongType()), T.StructField("at_us", T.LongType())])

    def release(due: DataFrame, past: DataFrame) -> DataFrame:
        # the last one that passed comes before all that is due: the walk starts there and it passes again
        passed = gating.rate_gate(due.unionByName(past).withColumn("at", F.timestamp_micros("at_us")), key.name, hertz, slot_seconds)
        return passed.join(past, schema.names, "left_anti").select(*schema.names)

    def remember(due: DataFrame, past: DataFrame, answer: DataFrame, edge: int) -> DataFrame:
        last = F.max(F.struct("at_us", "event_id")).alias("last")
        ends = answer.select(*schema.names).unionByName(past).groupBy(key.name).agg(last).select(key.name, "last.event_id", "last.at_us")
        return ends.filter(F.col("at_us") > edge - step)

    return Order(schema, key.name, release, remember, delay_seconds * 1_000_000)


def rolling(log: T.StructType, window: int, accumulation: int, delay_seconds: int, run: str = "run_id", idle_seconds: int | None = None) -> Order:
    """Means over the last `window` rows of each run, in time order: the answers of `evaluation.rolling_metrics`.

    Of each run the last `window` rows are kept with their position, whatever the length of the log. With `idle_seconds`, a
    run without rows for so long leaves the state; when it comes back it starts anew. `log` has the run, event_id, ts and
    the metrics.
    """
    schema = T.StructType([*log.fields, T.StructField("at_us", T.LongType()), T.StructField("timestep", T.LongType())])

    def numbered(due: DataFrame, past: DataFrame) -> DataFrame:
        start = past.groupBy(F.col(run).alias("__run")).agg((F.max("timestep") + 1).alias("__start"))
        order = ["at_us", "event_id"]
        placed = with_position(due.drop("timestep"), [run], order, time_block(F.timestamp_micros("at_us"), 60), "__nth")
        offset = F.coalesce("__start", F.lit(0))
        return placed.join(start, F.col(run) == F.col("__run"), "left").withColumn("timestep", F.col("__nth") + offset).select(*schema.names)

    def release(due: DataFrame, past: DataFrame) -> DataFrame:
        rows = numbered(due, past).withColumn("__new", F.lit(True)).unionByName(past.withColumn("__new", F.lit(False)))
        return evaluation.rolling_metrics(rows, window, accumulation, run).filter("__new").drop("__new")

    def remember(due: DataFrame, past: DataFrame, answer: DataFrame, edge: int) -> DataFrame:
        rows = answer.select(*schema.names).unionByName(past)
        ends = rows.groupBy(F.col(run).alias("__run")).agg(F.max("timestep").alias("__last"), F.max("at_us").alias("__at"))
        awake = F.lit(True) if idle_seconds is None else F.col("__at") > edge - idle_seconds * 1_000_000
        recent = rows.join(ends.filter(awake), F.col(run) == F.col("__run"))
        return recent.filter(F.col("timestep") > F.col("__last") - window).select(*schema.names)

    return Order(schema, run, release, remember, delay_seconds * 1_000_000)
