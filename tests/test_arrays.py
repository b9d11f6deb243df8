"""JSON arrays cut by many tasks equal the parser's own records; damage is an error."""

import json
import random

import pytest

from tests.test_lossless import record, write_day
from tidemark.schema import SNAPSHOT_RECORD
from tidemark.sources.arrays import read_json_arrays
from tidemark.sources.snapshots import read_snapshots

SCHEMA = "id long, name string, tags array<string>, inner struct<a: struct<b: string>, c: array<struct<d: int>>>"
NAMES = ["plain", "brace } in it", "{ open", '}"{', 'quote " and \\ and \\" }', "\\", "}}}{{{", "line\nbreak", "[1, {]}", "ünï 世界 } 😀", "", "end\\\\"]


def records(n, seed=0):
    rng = random.Random(seed)
    return [
        {"id": i, "name": rng.choice(NAMES), "tags": [rng.choice(NAMES) for _ in range(rng.randint(0, 3))],
         "inner": None if i % 5 == 0 else {"a": {"b": rng.choice(NAMES)}, "c": [{"d": k} for k in range(i % 3)]}}
        for i in range(n)
    ]


def schema():
    from pyspark.sql import types as T

    return T._parse_datatype_string(SCHEMA)


def plain(rows):
    return sorted((r["id"], r["name"], tuple(r["tags"]), json.dumps(r["inner"], sort_keys=True)) for r in rows)


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: (spark.conf.set("spark.sql.files.maxPartitionBytes", n), spark.conf.set("spark.sql.files.openCostInBytes", 1))
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("split", [37, 500, 1 << 27])
@pytest.mark.parametrize("dump", [{}, {"indent": 2}, {"separators": (",", ":")}, {"ensure_ascii": False, "indent": 1}])
def test_equals_the_parser(spark, tmp_path, small_splits, split, dump):
    data = records(40 if split == 37 else 300)
    (tmp_path / "a.json").write_text(json.dumps(data, **dump))
    (tmp_path / "b.json").write_text(" [ ] \n")
    small_splits(split)
    got = read_json_arrays(spark, f"{tmp_path}/*.json", schema())
    assert plain([r.asDict(recursive=True) for r in got.drop("file").collect()]) == plain(data)
    assert {r[0].rpartition("/")[2] for r in got.select("file").distinct().collect()} == {"a.json"}


@pytest.mark.parametrize("text", [
    json.dumps(records(5))[:-1], json.dumps(records(5))[:-2], json.dumps(records(5))[:-30], json.dumps(records(5))[:40], "[", "{}", '{"id": 1}', "[1, 2]",
    json.dumps(records(5))[1:], json.dumps(records(2)) + json.dumps(records(2)), '[{"id": 1} {"id": 2}]', '[{"id": 1},]', '[,{"id": 1}]', '[{"id": "x"}]',
    '[{"id": 1}, {"id": 2, "name": "cut', '[{"id": 1}, {"id": 2', '[{"id": 1}] trailing',
])
def test_damage_is_an_error(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="Malformed|MALFORMED|CANNOT_PARSE"):
        read_json_arrays(spark, f"{tmp_path}/a.json", schema()).collect()
    with pytest.raises(Exception, match="Malformed|MALFORMED|CANNOT_PARSE"):
        read_json_arrays(spark, f"{tmp_path}/a.json", schema()).count()


def test_a_day_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    day = "2024-01-01"
    write_day(tmp_path / "raw", day, [record(i, i, day, description="} \" {") for i in range(3000)])
    small_splits(64 << 10)
    tasks = spark.read.option("lineSep", "}").text(f"{tmp_path}/raw/*/snapshot.json").rdd.getNumPartitions()
    raw = read_snapshots(spark, f"{tmp_path}/raw")
    assert tasks > 8 and raw.count() == 3000
    assert raw.selectExpr("sum(stars)").first()[0] == sum(range(3000)) and raw.select("description").distinct().collect() == [('} " {',)]
    want = spark.read.schema(SNAPSHOT_RECORD).option("multiLine", True).json(f"{tmp_path}/raw/*/snapshot.json")
    assert raw.select("id", "name", "url").exceptAll(want.select("id", "name", "url")).count() == 0
