import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from notewright.errors import DatasetLoadError
from notewright.sources import catalog as catalog_source
from notewright.sources import notes as note_source
from notewright.sources import sinks
from notewright.sources.json_array import read_array


@pytest.fixture
def ranges(spark):
    """Sets the size of byte ranges."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}

    def size(n):
        for name, value in zip(names, (n, 1, 1)):
            spark.conf.set(name, str(value))

    yield size
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def value(rng, depth=0):
    kind = rng.randrange(8)
    if kind == 0:
        return rng.choice(["a}b", '"q"', "\\", 'x\\"}', "é{[", ",,", "]}", "", "line\nbreak", "漢}字"])
    if kind == 1:
        return rng.randrange(100)
    if kind == 2 and depth < 3:
        return [value(rng, depth + 1) for _ in range(rng.randrange(3))]
    if kind in (3, 4, 5) and depth < 3:
        return {rng.choice(["a", "b}", "notes", "dataset_name"]): value(rng, depth + 1) for _ in range(rng.randrange(3))}
    return None if kind == 6 else "word " * rng.randrange(9)


@pytest.mark.parametrize("size", [19, 60, 400, 10**7])
@pytest.mark.parametrize("shape", ["array", "object"])
def test_array_in_ranges_equals_the_parsed_text(spark, tmp_path, ranges, size, shape):
    """Braces, brackets, commas, quotes and escapes in strings, at the ends of ranges of any size."""
    rng = random.Random(size)
    for case, n in enumerate((0, 1, 2, 40)):
        items = [value(rng) for _ in range(n)]
        doc = items if shape == "array" else {"dataset_name": "my}set", "before": [1, {"notes": [1, 2]}], "notes": items, "after": [value(rng)]}
        path = tmp_path / f"{case}.json"
        path.write_text([" \n", ""][case % 2] + json.dumps(doc, indent=[None, 2][case // 2], ensure_ascii=case % 2 == 0) + ["", "\n"][case % 2])
        ranges(size)
        found = read_array(spark, str(path), "notes")
        rows = sorted(found.elements.collect())
        assert [r["pos"] for r in rows] == list(range(n)) and [json.loads(r["text"]) for r in rows] == items
        assert found.in_object == (shape == "object") and (size < 10**7 or found.name == (None if shape == "array" else "my}set"))


def test_a_large_array_is_read_by_many_tasks(spark, tmp_path, ranges):
    items = [{"id": f"n{i}", "text": "seen } today, [ again " * 20, "codes": ["I10"]} for i in range(2000)]
    path = tmp_path / "big set.v1.json"
    path.write_text(json.dumps(items))
    ranges(50_000)
    data = note_source.read_dataset(spark, f"file://{path}")
    assert data.name == "big set.v1" and spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() > 10
    notes = note_source.normalize_notes(data.raw).orderBy("pos").collect()
    assert [r["note_id"] for r in notes] == [f"n{i}" for i in range(2000)] and all(r["clinical_text"] == items[0]["text"] for r in notes)


@pytest.mark.parametrize("text", ["", "5", '{"a": [1]}', '[{"a": 1}', '[{"a": "x}', '{"notes": 5}', '[{"a": 1}]]', '{"notes": [1], "notes": [2]}'])
def test_other_texts_are_errors(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(DatasetLoadError):
        note_source.read_raw_notes(spark, str(tmp_path / "x.json"))
    with pytest.raises(DatasetLoadError, match="none.json"):
        note_source.read_raw_notes(spark, str(tmp_path / "none.json"))
    with pytest.raises(DatasetLoadError):
        (tmp_path / "o.json").write_text('{"notes": []}')
        catalog_source.read_catalog(spark, str(tmp_path / "o.json"))


def test_name_of_the_object_wins(spark, tmp_path):
    (tmp_path / "f.json").write_text('{"notes": [], "dataset_name": "own"}')
    assert note_source.read_dataset(spark, str(tmp_path / "f.json")).name == "own"


@pytest.mark.parametrize("n", [0, 1, 2, 500])
def test_written_parts_are_one_array(spark, tmp_path, n):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.createDataFrame([(i * 37 % 1009, None if i % 5 else "é}\n", ["a", "b"][: i % 3]) for i in range(n)], "i int, s string, a array<string>").repartition(5)
    for order in ("i", None, ["s", "i"]):
        path = tmp_path / ("-".join(order) if order else "none")
        sinks.write_json_array(rows, str(path), order)
        parts = sorted(path.glob("part-*"))
        got = json.loads("".join(p.read_text() for p in parts))
        assert sorted(r["i"] for r in got) == sorted(i * 37 % 1009 for i in range(n)) and all(set(r) == {"i", "s", "a"} for r in got)
        if order == "i":
            assert [r["i"] for r in got] == sorted(r["i"] for r in got) and (n < 500 or len(parts) > 1)
        back = read_array(spark, str(path))
        assert [json.loads(r["text"]) for r in sorted(back.elements.collect())] == got
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_equal_first_and_last_keys(spark, tmp_path):
    """Ties at both ends: one bracket each."""
    sinks.write_json_array(spark.createDataFrame([(1,)] * 3 + [(2,)] * 3 + [(None,)] * 2, "i int").repartition(4), str(tmp_path / "t"), "i")
    assert [r["i"] for r in json.loads("".join(p.read_text() for p in sorted((tmp_path / "t").glob("part-*"))))] == [None, None, 1, 1, 1, 2, 2, 2]


def test_saved_notes_have_a_stamped_name(spark, tmp_path):
    notes = spark.createDataFrame([("b", 1), ("a", 2)], "note_id string, x int")
    path = sinks.save_notes(notes, str(tmp_path), at=datetime(2024, 1, 2, 3, 4, 5))
    assert path == f"{tmp_path}/clinical_notes_20240102_030405.json"
    assert [json.loads(r["text"])["note_id"] for r in sorted(read_array(spark, path).elements.collect())] == ["a", "b"]


def test_two_readers_in_one_session(spark, tmp_path):
    for name, n in (("a", 2), ("b", 3)):
        (tmp_path / f"{name}.json").write_text(json.dumps([{"code": f"{name}{i}"} for i in range(n)]))
    a, b = (catalog_source.read_catalog(spark, str(tmp_path / f"{name}.json")) for name in "ab")
    assert (a.count(), b.count()) == (2, 3) and a.select(F.max("code")).head()[0] == "a1"
