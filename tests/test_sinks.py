"""What is written is what is read back."""

import json
import random
from functools import reduce
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from armature.operators import corpus, growing, statcache, statistics
from armature.sources import jsonarray, sinks, tables


def test_corpus_files_keep_the_shuffled_order(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(500)], "id long, text string")
    shuffled = corpus.shuffle_corpus(docs, ["id"], 7, 0)
    path = str(tmp_path / "corpus")
    sinks.write_corpus(shuffled, path, rows_per_file=100)
    files = sorted(Path(path).glob("part-*.json"))
    got = [json.loads(line)["id"] for f in files for line in f.read_text().splitlines()]
    assert got == [r["id"] for r in shuffled.orderBy("position").collect()]
    assert got != sorted(got) and sorted(got) == list(range(500))


def test_chat_examples_read_arrays_and_lines(spark, tmp_path):
    examples = [{"id": "1", "image": "a.jpg", "conversations": [{"from": "human", "value": "hi"}]}, {"id": "2", "conversations": []}]
    (tmp_path / "array.json").write_text(json.dumps(examples, indent=1))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, examples)))
    for name, array in (("array", True), ("lines", False)):
        got = tables.chat_examples(spark, str(tmp_path / f"{name}.json"), array).orderBy("id").collect()
        assert [(r["id"], r["image"], len(r["conversations"])) for r in got] == [("1", "a.jpg", 1), ("2", None, 0)]


NASTY = ['plain', 'a "quoted" {brace} [x]', 'ends in \\', '\\\\" ] } , {', 'é漢😀', '', '\n\t"', '\\' * 50, '{"id": "fake"}', 'x' * 700]


@pytest.mark.parametrize("range_bytes", [1, 7, 64, 1 << 20])
@pytest.mark.parametrize("indent", [None, 1])
def test_array_files_are_cut_at_any_byte(spark, tmp_path, range_bytes, indent):
    if range_bytes == 1:
        examples = [{"id": "1", "conversations": [{"from": 'a"b', "value": "}\\"}]}]
    else:
        examples = [{"id": str(i), "note": {"deep": [[i], {"x": NASTY[-1 - i % 10]}]}, "conversations": [{"from": "human", "value": t}]} for i, t in enumerate(NASTY * 3)]
    (tmp_path / "a.json").write_text(json.dumps(examples, indent=indent, ensure_ascii=False))
    (tmp_path / "b.json").write_text(" [ ]\n")
    (tmp_path / "c.json").write_text("")
    (tmp_path / "d.json").write_text('[1, "{", [{"id": "inner"}], {"id": "last"}]')
    if range_bytes == 7:
        range_bytes = 701 if indent else 97
    found = jsonarray.array_objects(spark, str(tmp_path), range_bytes=range_bytes).collect()
    got = [json.loads(r["value"]) for r in sorted(found, key=lambda r: (r["path"], r["at"]))]
    assert got == [*examples, {"id": "last"}]


def test_a_broken_array_is_an_error(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": "1"}, {"id": "2"}')
    with pytest.raises(Exception, match="not one closed JSON array"):
        jsonarray.array_objects(spark, str(tmp_path)).collect()


def test_written_arrays_are_json(spark, tmp_path):
    rows = spark.createDataFrame([(i, str(i), NASTY[i % 10]) for i in range(25)], "position long, id string, text string")
    sinks.write_json_arrays(rows, str(tmp_path / "out"), 10)
    files = sorted(Path(tmp_path / "out").glob("shard=*/part-*"))
    got = [json.loads(f.read_text()) for f in files]
    assert [len(g) for g in got] == [10, 10, 5]
    assert [e for g in got for e in g] == [{"id": str(i), "text": NASTY[i % 10]} for i in range(25)]


def test_a_file_per_shard_and_its_manifest(spark, tmp_path):
    path = str(tmp_path / "shards")
    sinks.write_frame_shards(spark.range(1050).withColumnRenamed("id", "position"), path, 100)
    files = {f"{f.parent.name}/{f.name}" for f in Path(path).glob("shards/shard=*/*.parquet")}
    manifest = sinks.shard_manifest(spark, path).orderBy("shard").collect()
    assert [(r["shard"], r["n_rows"], r["first_position"], r["last_position"]) for r in manifest] == [
        (i, min(100, 1050 - 100 * i), 100 * i, min(1049, 100 * i + 99)) for i in range(11)
    ]
    assert len(files) == 11 and {r["file"] for r in manifest} == files


def test_statistics_are_computed_once_per_spec(spark):
    path = sinks.scratch(spark, "cache")
    steps = spark.createDataFrame([("a", 1, [1.0, 2.0]), ("b", 1, [3.0, 4.0])], "dataset_name string, episode_id int, action array<double>")
    first = statcache.statistics_with_cache(steps, path, "state", "v1").collect()
    again = statcache.statistics_with_cache(steps, path, "state", "v1").collect()
    other = statcache.statistics_with_cache(steps, path, "state", "v2").collect()
    assert [{r["was_cached"] for r in rows} for rows in (first, again, other)] == [{False}, {True}, {False}]
    assert spark.read.parquet(path).count() == 4


def test_empty_demo_table_reads_back(spark):
    path = sinks.scratch(spark, "none")
    none = spark.createDataFrame([("a", 1)], "dataset_name string, episode_id int").filter(F.lit(False))
    sinks.write_demos(none, path)
    assert tables.episodes(spark, path, schema=none.schema).count() == 0


def test_statistics_file_is_one_object_keyed_by_dataset(spark, tmp_path):
    numbers = {k: [0.5, 1.0] for k in ("mean", "std", "min", "max", "q01", "q99")}
    theirs = {"a": {"action": {**numbers, "mask": [True, False]}, "proprio": numbers, "num_transitions": 7, "num_trajectories": 2}, "b": {"action": numbers, "num_transitions": 1, "num_trajectories": 1}}
    (tmp_path / "dataset_statistics.json").write_text(json.dumps(theirs, indent=2))
    read = tables.saved_statistics(spark, str(tmp_path / "dataset_statistics.json"))
    assert {r["dataset_name"]: (r["action"]["mask"], r["proprio"] is None, r["num_transitions"]) for r in read.collect()} == {"a": ([True, False], False, 7), "b": (None, True, 1)}
    path = str(tmp_path / "out.json")
    sinks.write_statistics(read, path)
    (file,) = Path(path).glob("part-*")
    back = json.loads(file.read_text())
    assert back["a"] == theirs["a"] and set(back) == {"a", "b"}
    assert sorted(tables.saved_statistics(spark, path).collect(), key=str) == sorted(read.collect(), key=str)


def test_a_stored_validation_split_is_kept(spark):
    from armature.operators import mixtures

    rows = [("own", e, "val" if e == 3 else "train") for e in range(6)] + [("cut", e, "train") for e in range(100)]
    steps = spark.createDataFrame(rows, "dataset_name string, episode_id int, stored string")
    got = {(r["dataset_name"], r["episode_id"]): r["split"] for r in mixtures.split_by_episode(steps, 95, stored="stored").collect()}
    assert {e for (d, e), s in got.items() if d == "own" and s == "val"} == {3}
    assert {e for (d, e), s in got.items() if d == "cut" and s == "val"} == set(range(95, 100))


def test_statistics_grow_with_new_episodes(spark, tmp_path):
    rnd = random.Random(2)
    rows = []
    for e in range(30):
        wide = e % 2 == 0  # dataset "b" has narrower actions
        rows += [("a" if wide else "b", e, t, [1e9 + rnd.gauss(e, 1)] + ([rnd.random()] if wide else []), [float(t)]) for t in range(50)]
    steps = spark.createDataFrame(rows, "dataset_name string, episode_id int, timestep int, action array<double>, proprio array<double>")
    path, widths = str(tmp_path / "grown"), {"action": 2, "proprio": 1}
    for name, low, high in (("0", 0, 10), ("1", 10, 11), ("2", 11, 30), ("1", 10, 11)):
        growing.add_episodes(steps.filter((steps.episode_id >= low) & (steps.episode_id < high)), path, name, widths)
    growing.compact(spark, path, str(tmp_path / "small"))
    want = {(r["dataset_name"], r["key"], r["dim"]): r for r in statistics.dimension_statistics(steps).collect()}
    for folder in (path, str(tmp_path / "small")):
        got = {(r["dataset_name"], r["key"], r["dim"]): r for r in growing.grown_statistics(spark, folder).collect()}
        assert set(got) == set(want) and len(got) == 5
        for g, w in got.items():
            assert w["n"] == 750 and all(abs(w[c] - want[g][c]) < 1e-5 for c in ("mean", "std", "min", "max"))
        sizes = {r["dataset_name"]: (r["num_transitions"], r["num_trajectories"]) for r in growing.grown_sizes(spark, folder).collect()}
        assert sizes == {"a": (750, 15), "b": (750, 15)}
    values = sorted(r[3][0] for r in rows if r[0] == "a")
    first = {(r["dataset_name"], r["key"], r["dim"]): r for r in growing.grown_statistics(spark, path).collect()}["a", "action", 0]
    assert abs(values.index(first["q01"]) - 7.5) <= 1 and abs(values.index(first["q99"]) - 742) <= 1


def test_growing_sketches_keep_their_rank_error(spark):
    rows = spark.range(200_000).selectExpr("'a' AS dataset_name", "CAST(id AS INT) AS timestep", "array(CAST(id * 7919 % 200000 AS DOUBLE)) AS action", "CAST(id % 20 AS INT) AS batch")
    parts = [growing.partial_statistics(rows.filter(F.col("batch") == b), {"action": 1}) for b in range(20)]
    row = growing.merged(reduce(lambda x, y: x.unionByName(y), parts)).first()
    for q, p in (("q01", 0.01), ("q99", 0.99)):
        assert abs(row[q] / 200_000 - p) <= growing.RANK_SLACK
