"""Array files cut into byte ranges, next to a plain reader."""

import json
import random

import pytest

from speechframe.catalog import base
from speechframe.sources import json_arrays, readers, sinks

SCHEMA = "index long, transcript string, tags array<string>, meta struct<a: string, list: array<struct<b: long>>>"


def rows(n, seed=1):
    rng = random.Random(seed)
    pieces = ['"', "\\", "\\\\", '\\"', "{", "}", "[", "]", ",", ":", "\n", "é", "日本", "🙂", "\t", "/", "plain words ", " ", "\x7f"]
    text = lambda: "".join(rng.choices(pieces, k=rng.randint(0, 12)))
    return [{"index": i, "transcript": text(), "tags": [text(), text()], "meta": {"a": text(), "list": [{"b": i}, {"b": -i}]}} for i in range(n)]


def texts(path, size, range_bytes):
    """All objects of one file, by the two scans of ``read_objects`` without Spark."""
    ranges = [(path, at, min(size, at + range_bytes)) for at in range(0, size, range_bytes)]
    pieces = json_arrays.put_together([json_arrays.summarize(*r) for r in ranges], {(p, a): b for p, a, b in ranges})
    return [t for piece in pieces for found in json_arrays.objects(*piece) for t in found]


@pytest.mark.parametrize("form", [{"indent": 2}, {}, {"ensure_ascii": False}, {"ensure_ascii": False, "indent": 1}])
@pytest.mark.parametrize("range_bytes", [1, 2, 3, 7, 64, 1000, 10**9])
def test_every_cut_gives_the_same_objects(tmp_path, monkeypatch, form, range_bytes):
    want = rows(12 if range_bytes < 10 else 200)
    file = tmp_path / "a.json"
    file.write_text(json.dumps(want, **form), encoding="utf-8")
    monkeypatch.setattr(json_arrays, "BLOCK", 50)  # so that strings and runs of backslashes are cut between blocks as well
    monkeypatch.setattr(json_arrays, "TAIL", 11)
    monkeypatch.setattr(json_arrays, "LOOK_BACK", 2)
    assert list(map(json.loads, texts(str(file), file.stat().st_size, range_bytes))) == want


@pytest.mark.parametrize("content, want", [
    ("", []), ("  ", []), ("[]", []), ("[ \n]", []), ('{"index": 1}', [{"index": 1}]), ('﻿[{"index": 1}]', [{"index": 1}]),
    ('  \n[{"index": 1}, 3, null, [{"index": 9}], "x{}", {"index": 2}]', [{"index": 1}, {"index": 2}]),
    ('{"index": 1}\n{"index": 2}', [{"index": 1}, {"index": 2}]), ('[{"index": "\\\\\\\\\\""}]', [{"index": '\\\\"'}]), ("[{}]", [{}]),
])
def test_awkward_files(tmp_path, content, want):
    file = tmp_path / "a.json"
    file.write_text(content, encoding="utf-8")
    size = len(content.encode())
    for range_bytes in (1, 4, 100):
        if range_bytes > 3 or content[:1] != "﻿":  # a range holds a byte order mark whole
            assert list(map(json.loads, texts(str(file), size, range_bytes))) == want, range_bytes


def test_several_tasks_read_one_file(spark, tmp_path):
    want = rows(3_000)
    (tmp_path / "big.json").write_text(json.dumps(want, indent=2, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "small.json").write_text(json.dumps(rows(5, 2)), encoding="utf-8")
    (tmp_path / "empty.json").write_text("")
    plain = spark.read.schema(SCHEMA).option("multiLine", True).json(f"{tmp_path}/*.json")
    cut = readers.read_records(spark, f"{tmp_path}/*.json", plain.schema, range_bytes=50_000)
    assert cut.rdd.getNumPartitions() > 8
    order = lambda df: sorted(map(repr, df.collect()))
    assert order(cut) == order(plain.where("index IS NOT NULL"))


def test_a_task_reads_many_small_ranges(spark, tmp_path):
    want = rows(3_000)
    (tmp_path / "big.json").write_text(json.dumps(want))
    size = (tmp_path / "big.json").stat().st_size
    cut = readers.read_records(spark, f"{tmp_path}/*.json", spark.createDataFrame([], SCHEMA).schema, range_bytes=500)
    cores = spark.sparkContext.defaultParallelism
    assert size > 500 * 20 * cores and cores < cut.rdd.getNumPartitions() <= 3 * cores
    assert cut.count() == len(want)


def test_packed_files_are_read_whole(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "a.json.gz", "wt") as out:
        json.dump(rows(30), out)
    (tmp_path / "b.json").write_text(json.dumps(rows(20)))
    assert readers.read_records(spark, f"{tmp_path}/*", spark.createDataFrame([], SCHEMA).schema, range_bytes=500).count() == 50


def test_written_arrays_are_valid(spark, tmp_path, sf):
    given = base.samples(spark, sf)
    sinks.write_record_arrays(given, f"{tmp_path}/out", files=3)
    files = list((tmp_path / "out").glob("part-*"))
    held = [json.loads(f.read_text()) for f in files]
    assert len(files) == 3 and sum(map(len, held)) == given.count()
    sinks.write_record_arrays(given.where("false"), f"{tmp_path}/none")
    assert readers.read_records(spark, f"{tmp_path}/none", given.schema).count() == 0
