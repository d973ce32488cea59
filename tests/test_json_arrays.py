"""SRC-2: arrays cut at braces and read by many tasks equal the one-task reader."""

import json
import random

import pytest

from eventlake.sources.landing import read_json_arrays, read_json_documents

TEXT = ['}', '{', ']', '[', '"', '\\', '\\"', '},{', ']}', 'é日', '\n', ',', 'plain', '\\u007d', ' ']


def some(rnd, deep=0):
    kind = rnd.randint(0, 5 if deep < 3 else 2)
    if kind < 3:
        return rnd.choice([None, True, 12, -1.5, "".join(rnd.choices(TEXT, k=rnd.randint(0, 5)))])
    if kind == 3:
        return [some(rnd, deep + 1) for _ in range(rnd.randint(0, 3))]
    return {"".join(rnd.choices(TEXT, k=2)) + str(i): some(rnd, deep + 1) for i in range(rnd.randint(0, 3))}


def event(rnd, i):
    return {"id": str(i), "payload": some(rnd), "actor": {"login": "".join(rnd.choices(TEXT, k=3))}}


@pytest.fixture()
def small_splits(spark):
    """Files are cut every 200 bytes or so."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "200")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def lines(df):
    return [(r["arrival_file"], r["arrival_pos"], r["value"]) for r in df.orderBy("arrival_file", "arrival_pos").collect()]


@pytest.mark.parametrize("style", [{}, {"indent": 2}, {"separators": (",", ":")}, {"ensure_ascii": False, "indent": 1}])
def test_split_files_equal_whole_ones(spark, tmp_path, small_splits, style):
    rnd = random.Random(str(style))
    for f in range(3):
        (tmp_path / f"{f}.json").write_text(json.dumps([event(rnd, i) for i in range(60)], **style) + rnd.choice(["", "\n", " \n "]))
    path = str(tmp_path / "*.json")
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 20
    got = lines(read_json_arrays(spark, path))
    assert got == lines(read_json_documents(spark, path)) and len(got) == 180


def test_elements_that_are_no_objects(spark, tmp_path, small_splits):
    docs = {"a": [1, "x}", {"id": 1}, [{"id": 2}], None, {"id": 3}, {}, [], "]"], "b": [], "c": [5], "d": [{}], "e": [[]], "f": [{"id": "[" * 300}] * 5}
    for name, doc in docs.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(doc))
    path = str(tmp_path / "*.json")
    value = lambda df: sorted((r["arrival_file"], r["value"]) for r in df.collect())
    assert value(read_json_arrays(spark, path)) == value(read_json_documents(spark, path))


def test_files_that_are_no_arrays(spark, tmp_path, small_splits):
    files = {"object": '{"not": {"an": "array"}}', "text": "junk } junk {", "open": '{"a": 1', "lines": '{"id":1}\n{"id":2}\n', "blank": " \n"}
    for name, text in files.items():
        (tmp_path / f"{name}.json").write_text(text)
    (tmp_path / "empty.json").write_text("")
    got = {r["arrival_file"].split("/")[-1][:-5]: r["value"] for r in read_json_arrays(spark, str(tmp_path / "*.json")).collect()}
    assert got == files


def test_damaged_arrays_lose_only_what_is_damaged(spark, tmp_path):
    files = {"cut": '[{"id":1},{"id":2},{"id":3', "cut2": '[{"id":1},{"id":2}', "bad": '[{"id":1},{"id":oops},{"id":3}]', "junk": '[{"id":1}] junk'}
    for name, text in files.items():
        (tmp_path / f"{name}.json").write_text(text)
    got = {}
    for r in read_json_arrays(spark, str(tmp_path / "*.json")).orderBy("arrival_pos").collect():
        got.setdefault(r["arrival_file"].split("/")[-1][:-5], []).append(r["value"])
    assert got == {"cut": ['{"id":1}', '{"id":2}', ',{"id":3'], "cut2": ['{"id":1}', '{"id":2}'],
                   "bad": ['{"id":1}', ',{"id":oops}', '{"id":3}'], "junk": ['{"id":1}', "] junk"]}


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    """One array of 200,000 events on one line."""
    path = tmp_path / "large.json"
    with open(path, "w") as out:
        out.write("[" + ",".join(f'{{"id":"{i}","type":"}}{{\\"","actor":{{"id":{i}}}}}' for i in range(200_000)) + "]")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() > 10
        got = read_json_arrays(spark, str(path)).selectExpr(
            "count(*)", "count_if(get_json_object(value, '$.id') = string(arrival_pos))", "count(DISTINCT arrival_pos)").first()
        assert tuple(got) == (200_000,) * 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
