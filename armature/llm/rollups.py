"""Token totals by source, language and tokenizer version, kept up to date by signed changes.

A store is a folder of three parts:

* `changes`: signed rows of documents, by attempt and bucket of the id: +1 with the counts that hold from now on, -1 with those
  that no longer do;
* `deltas`: the changes of an attempt added up by source, language and tokenizer;
* `commits`: one small file per version, which names the batch and the attempt that counts.

A batch is worked out against a committed version, written under an attempt name of its own, and committed as the next version.
A version can be made only once: of two batches that started from the same version the second is worked out again, so none
takes out counts that the other has taken out before. Attempts without a commit are never read, so a job that died leaves
nothing to undo, and a batch whose name is committed is not applied again: replays are free.

Totals are the sum of committed deltas. An update reads the buckets of the documents that it names, in the changes since the
last `compact`, which brings all that holds into one attempt.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from armature.llm import textkit

KEYS = ("source", "lang", "tokenizer")
ROW = "doc_id long, source string, lang string, tokenizer string, tokens long, chars long, sign int"
CHANGES = ROW + ", attempt string, bucket int"
DELTAS = "source string, lang string, tokenizer string, docs long, tokens long, chars long, attempt string"
COMMITS = "version long, batch string, attempt string, base boolean, buckets int"
#: Buckets of a new store. Take more for a large one: an update of a few documents reads one part in so many for each.
BUCKETS = 64
#: How often a batch is worked out again because another was committed first.
RETRIES = 10


# ---- counters -------------------------------------------------------------------------------------------------------


def words(text: Column) -> Column:
    """Runs without white space."""
    return F.regexp_count(text, F.lit(textkit.WORD_PATTERN)).cast("long")


def pieces(text: Column) -> Column:
    """Runs of letters, runs of digits, and every other character but white space for itself."""
    return F.regexp_count(text, F.lit(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]")).cast("long")


def byte_pairs(path: str) -> Callable[[Column], Column]:
    """Tokens of a public vocabulary for the tokenizers library. The file is read by the driver and travels with the job."""
    with open(path, encoding="utf-8") as f:
        vocabulary = f.read()

    def count(text: Column) -> Column:
        @F.pandas_udf("long")
        def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            from tokenizers import Tokenizer

            made = Tokenizer.from_str(vocabulary)
            made.encode_special_tokens = True
            for texts in batches:
                found = []
                for at in range(0, len(texts), 64):
                    found += [len(x.ids) for x in made.encode_batch(texts.iloc[at : at + 64].tolist(), add_special_tokens=False)]
                yield pd.Series(found, dtype="int64")

        return tokens(text)

    return count


def counted(docs: DataFrame, counters: Mapping[str, Callable[[Column], Column]], text: str = "text") -> DataFrame:
    """(doc_id, source, lang, tokenizer, tokens, chars) with a row per document and tokenizer version, texts read once.

    A null text has no tokens and no characters."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    wide = docs.select("doc_id", F.col("source").cast("string"), F.col("lang").cast("string"), F.length(body).cast("long").alias("chars"), *[c(body).alias(f"count_{i}") for i, c in enumerate(counters.values())])
    rows = F.array(*[F.struct(F.lit(name).alias("tokenizer"), F.col(f"count_{i}").alias("tokens")) for i, name in enumerate(counters)])
    return wide.select("doc_id", "source", "lang", "chars", F.explode(rows).alias("t")).select("doc_id", "source", "lang", "t.tokenizer", "t.tokens", "chars")


# ---- store ----------------------------------------------------------------------------------------------------------


class Store:
    """The number of buckets is fixed when the folder is first used."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark, self.folder = spark, folder.rstrip("/")
        if not self._commit(0, {"base": True, "buckets": buckets}):
            (made,) = self._log().filter("version = 0").collect()
            buckets = made["buckets"]
        self.buckets = buckets

    # ---- versions

    def _commit(self, version: int, line: Mapping) -> bool:
        """Makes a version, unless it is there: a whole file takes its name, and the file system gives a name only once."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        hadoop = jvm.org.apache.hadoop.fs
        made, name = hadoop.Path(f"{self.folder}/commits/.{uuid.uuid4().hex}"), hadoop.Path(f"{self.folder}/commits/{version:012d}.json")
        files = made.getFileSystem(conf)
        out = files.create(made, False)
        out.write(bytearray(json.dumps({"version": version, **line}).encode()))
        out.close()
        rename = getattr(hadoop, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.NONE
        try:
            hadoop.FileContext.getFileContext(files.getUri(), conf).rename(made, name, how)
        except Py4JJavaError:
            if files.exists(made) and files.exists(name):
                files.delete(made, False)
                return False
            raise
        return True

    def _log(self) -> DataFrame:
        return self.spark.read.schema(COMMITS).json(f"{self.folder}/commits").filter("version IS NOT NULL")

    def commits(self) -> DataFrame:
        """(version, batch, attempt) of the batches."""
        return self._log().filter("batch IS NOT NULL").select("version", "batch", "attempt")

    def holds(self, batch: str) -> bool:
        return not self._log().filter(F.col("batch") == batch).isEmpty()

    def _newest(self) -> tuple[int, list[str]]:
        """The newest version, and the attempts to read for it: the last compacted one and those since."""
        log = self._log()
        version, base = log.agg(F.max("version"), F.max(F.when(F.col("base"), F.col("version")))).first()
        live = log.filter((F.col("version") >= base) & (F.col("version") <= version) & F.col("attempt").isNotNull())
        return version, [r["attempt"] for r in live.select("attempt").distinct().collect()]

    def _attempts(self, name: str, schema: str, attempts: Sequence[str]) -> DataFrame:
        if not attempts:
            return self.spark.createDataFrame([], schema)
        folder = f"{self.folder}/{name}"
        return self.spark.read.schema(schema).option("basePath", folder).parquet(*[f"{folder}/attempt={a}" for a in attempts])

    # ---- what holds

    def bucket(self, doc_id: Column) -> Column:
        return F.pmod(F.xxhash64(doc_id.cast("long")), F.lit(self.buckets)).cast("int")

    def _current(self, attempts: Sequence[str], buckets: Sequence[int] | None = None) -> DataFrame:
        changes = self._attempts("changes", CHANGES, attempts)
        if buckets is not None:
            changes = changes.filter(F.col("bucket").isin(list(buckets)))
        net = changes.groupBy("doc_id", *KEYS, "tokens", "chars").agg(F.sum("sign").alias("copies"))
        return net.filter(F.col("copies") > 0)

    def current(self) -> DataFrame:
        """The counts that hold: signed rows that do not cancel out. Added up before the shuffle."""
        return self._current(self._newest()[1])

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens, chars); groups that no document is in are left out."""
        return self._totals(self._newest()[1])

    def _totals(self, attempts: Sequence[str]) -> DataFrame:
        sums = self._attempts("deltas", DELTAS, attempts).groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in ("docs", "tokens", "chars")])
        return sums.filter((F.col("docs") != 0) | (F.col("tokens") != 0) | (F.col("chars") != 0))

    # ---- updates

    def put(self, batch: str, rows: DataFrame) -> bool:
        """Adds counts; they replace those of the same document and tokenizer version, if there are any."""
        return self.apply(batch, rows, None)

    def delete(self, batch: str, ids: DataFrame) -> bool:
        """Takes out all counts of the documents `ids.doc_id`."""
        return self.apply(batch, None, ids)

    def _write_changes(self, rows: DataFrame, attempt: str) -> None:
        # rows without an id are never named again: they are dealt by what they hold
        bucket = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64(*KEYS, "tokens", "chars"), F.lit(self.buckets)).cast("int"))
        dealt = rows.withColumn("bucket", bucket.otherwise(self.bucket(F.col("doc_id")))).repartition("bucket")
        dealt.write.mode("append").partitionBy("bucket").parquet(f"{self.folder}/changes/attempt={attempt}")

    def _write_deltas(self, deltas: DataFrame, attempt: str) -> None:
        deltas.write.mode("append").parquet(f"{self.folder}/deltas/attempt={attempt}")

    def apply(self, batch: str, rows: DataFrame | None, gone: DataFrame | None) -> bool:
        """One batch: take out `gone` (doc_id), put in `rows` as `counted` gives them. False if the batch was applied before.

        Rows without an id cannot be named later and are only ever added. Where a batch has several rows for a document and
        tokenizer the one with the most tokens, then characters, source and language holds. A document both put in and taken
        out holds its new counts. Unknown ids in `gone` change nothing.
        """
        put = None
        for tries in range(RETRIES):
            version, live = self._newest()
            if self.holds(batch):
                return False
            if put is None:  # what is put in does not depend on what was there: texts are counted once
                put = uuid.uuid4().hex
                self._write_changes(self._best(rows) if rows is not None else self.spark.createDataFrame([], ROW), put)
            attempt = self._worked_out(put, live, gone, tries == 0)
            if self._commit(version + 1, {"batch": batch, "attempt": attempt}):
                return True
        raise RuntimeError(f"{RETRIES} other batches were committed while {batch} was worked out")

    @staticmethod
    def _best(rows: DataFrame) -> DataFrame:
        """One row for a document and tokenizer, to be put in."""
        best = F.max(F.struct("tokens", "chars", F.coalesce("source", F.lit("")).alias("s"), F.coalesce("lang", F.lit("")).alias("l"), "source", "lang"))
        named = rows.filter(F.col("doc_id").isNotNull()).groupBy("doc_id", "tokenizer").agg(best.alias("b"))
        one = named.select("doc_id", "b.source", "b.lang", "tokenizer", "b.tokens", "b.chars")
        return one.unionByName(rows.filter(F.col("doc_id").isNull()).select(one.columns)).withColumn("sign", F.lit(1))

    def _worked_out(self, put: str, live: Sequence[str], gone: DataFrame | None, first: bool) -> str:
        """An attempt with what was put in and, against the state of `live`, what that and `gone` take out."""
        columns = ["doc_id", *KEYS, "tokens", "chars", "sign"]
        new = self._attempts("changes", CHANGES, [put]).filter("sign > 0")
        attempt = put
        if not first:
            attempt = uuid.uuid4().hex
            self._write_changes(new.select(columns), attempt)
        if live:
            keys = new.filter(F.col("doc_id").isNotNull()).select("doc_id", "tokenizer")
            ids = self.spark.createDataFrame([], "doc_id long") if gone is None else gone.select(F.col("doc_id").cast("long")).distinct()
            ids = ids.filter(F.col("doc_id").isNotNull())
            touched = keys.select("doc_id").unionByName(ids).select(self.bucket(F.col("doc_id")).alias("bucket")).distinct()
            was = self._current(live, [r["bucket"] for r in touched.collect()]).filter(F.col("doc_id").isNotNull())
            out = was.join(ids, "doc_id", "left_anti").join(keys, ["doc_id", "tokenizer"], "left_semi")
            if gone is not None:
                out = out.unionByName(was.join(ids, "doc_id", "left_semi").select(out.columns))
            self._write_changes(out.withColumn("sign", -F.col("copies").cast("int")).select(columns), attempt)
        signed = lambda c: F.sum(F.col("sign") * c)
        written = self._attempts("changes", CHANGES, [attempt])
        self._write_deltas(
            written.groupBy(*KEYS).agg(signed(F.lit(1)).cast("long").alias("docs"), signed(F.col("tokens")).alias("tokens"), signed(F.col("chars")).alias("chars")),
            attempt,
        )
        return attempt

    def compact(self) -> None:
        """Everything that holds as one attempt, from which later updates start. Totals stay as they are."""
        for _ in range(RETRIES):
            version, live = self._newest()
            attempt = uuid.uuid4().hex
            self._write_changes(self._current(live).withColumn("sign", F.col("copies").cast("int")).drop("copies"), attempt)
            self._write_deltas(self._totals(live), attempt)
            if self._commit(version + 1, {"attempt": attempt, "base": True}):
                return
        raise RuntimeError(f"{RETRIES} batches were committed while the store was compacted")
