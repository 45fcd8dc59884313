"""Registered queries against their SQL, and the pipeline against what its stages must do."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from armature.llm import decontaminate, simhash
from armature.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="supplied tables are not here")


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in sorted(Path(FOLDER).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    found = con.execute(ORACLES[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    want = sorted(([r[names.index(c)] for c in columns] for r in found.fetchall()), key=repr)
    assert sorted(([r[c] for c in columns] for r in df.collect()), key=repr) == want


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join(spark, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    if name == "op6_source_mixing":
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


CONTRACT = {
    "op3_line_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op4_simhash_dedup": "doc_id bigint, fingerprint string, component_id bigint",
    "op5_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op6_source_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op7_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op13_personal_data": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op8_quality_gam": "doc_id bigint, held_out boolean, score double, predicted int",
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns_and_rows_of_the_contract(spark, name):
    df = QUERIES[name](spark, FOLDER)
    kinds = dict(df.dtypes)
    assert {c: kinds[c] for c, _ in (x.split() for x in CONTRACT[name].split(", "))} == dict(x.split() for x in CONTRACT[name].split(", "))
    assert df.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def stages(spark, tmp_path, docs, folder=FOLDER):
    out = []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / f"{number}")
        stage(spark, docs, folder).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return out


def test_stages_do_what_they_say(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("score", F.lit("clash")).withColumn("found_share", F.lit(1))
    more = spark.createDataFrame([(900_000, "12345 !!!", "en", "src0", 9), (900_001, None, None, None, None), (None, "", "en", "src1", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.unionByName(more, allowMissingColumns=True).unionByName(docs.limit(5))
    run = {name: (a, b) for name, a, b in stages(spark, tmp_path, docs)}
    for name, (a, b) in list(run.items())[:-1]:
        assert b.columns == docs.columns and b.count() < a.count(), name
    gone = lambda name: run[name][0].join(run[name][1], "doc_id", "left_anti")
    assert sorted((r.doc_id or 0) for r in gone("language_id").collect()) == [0, 900_000, 900_001] and run["language_id"][1].filter("doc_id is null").count() == 0
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    verdicts = {(r.quality, r.kept): r["count"] for r in run["quality_classifier"][0].join(labels, "doc_id").join(run["quality_classifier"][1].select("doc_id", F.lit(True).alias("kept")).distinct(), "doc_id", "left").groupBy("quality", "kept").count().collect()}
    assert verdicts.get((1, None), 0) <= 0.03 * verdicts[1, True] and verdicts.get((0, True), 0) <= 0.1 * verdicts[0, None]
    before, after = run["near_duplicates"]
    groups = simhash.near_duplicates(before).collect()
    assert sorted(r.doc_id for r in after.collect()) == sorted({r.component_id for r in groups})
    held = {r.doc_id for r in decontaminate.overlaps(run["decontamination"][0], spark.read.parquet(f"{FOLDER}/benchmark.parquet"), ["doc_id"]).collect()}
    assert held and {r.doc_id for r in gone("decontamination").collect()} == held
    mixed, kept = run["source_mixing"][1].collect(), run["decontamination"][1]
    assert sorted(r.doc_id for r in mixed) == sorted(r.doc_id for r in kept.collect())


def test_run_gives_the_rows_of_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "taken", "target"} <= set(rows.columns) and rows.count() > 0


def test_stages_on_an_empty_table(spark, tmp_path):
    empty = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    assert all(b.count() == 0 for _, _, b in stages(spark, tmp_path, empty))


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


def test_rules_query_equals_plain_python(spark):
    from test_rules import plain

    texts = dict(documents(spark))
    for r in QUERIES["op3_line_rules"](spark, FOLDER).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(texts[r.doc_id])
        assert r.kept == (not r.base_failed and r.lost_share <= 0.5)


def test_near_duplicate_query_equals_brute_force(spark):
    from test_simhash import fingerprint, roots

    prints = {d: fingerprint(t) for d, t in documents(spark)}
    root = roots(set(prints.values()), 4)
    first = {}
    for d, f in sorted(prints.items()):
        first.setdefault(root[f], d)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op4_simhash_dedup"](spark, FOLDER).collect()}
    assert got == {d: (f"{f:016x}", first[root[f]]) for d, f in prints.items()}


def test_decontamination_query_equals_brute_force(spark):
    import re

    import numpy as np

    ids = {}
    number = lambda t: np.array([ids.setdefault(w, len(ids)) for w in re.findall(r"[a-z0-9À-῿]+", (t or "").lower())])
    items = [(r.item_id, number(r.text)) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    want = set()
    for d, text in documents(spark):
        words = number(text)
        for i, item in items:
            n = min(13, len(item))
            if n >= 5 and len(words) >= n:
                seen = np.lib.stride_tricks.sliding_window_view(words, n)
                if any(((seen == w).sum(1) >= n - int(n * 0.2 + 1e-9)).any() for w in np.lib.stride_tricks.sliding_window_view(item, n)):
                    want.add((d, i))
    assert {(r.doc_id, r.item_id) for r in QUERIES["op1_decontamination"](spark, FOLDER).collect()} == want and want


@pytest.mark.parametrize("name, label", [("op5_toxicity", "toxic"), ("op8_quality_gam", "quality")])
def test_held_out_accuracy_of_the_queries(spark, name, label):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = QUERIES[name](spark, folder).filter("held_out").join(labels, "doc_id").collect()
    right = sum(r.predicted == r[label] for r in rows)
    assert len(rows) > 50 and right >= 0.93 * len(rows)


def test_held_out_accuracy_of_languages(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op7_language_id"](spark, folder).filter("held_out").join(docs, "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.98 * len(rows)
