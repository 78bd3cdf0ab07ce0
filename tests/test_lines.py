"""Line files of all kinds, damaged ones, and shards within their limits."""

import glob
import gzip
import json
import os
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from loomtab.sources import lines as L


def write(path, data):
    with open(path, "wb") as f:
        f.write(data)


def test_all_kinds_side_by_side(spark, tmp_path):
    made = {f"{k}{i}": [json.dumps({"id": i, "kind": k, "text": "漢" * (i % 40)}, ensure_ascii=False) for i in range(300)] for i in range(2) for k in "abcd"}
    for name, rows in made.items():
        data = ("\r\n" if name[0] == "d" else "\n").join(rows).encode() + b"\n" * (name[1] == "0")
        if name[0] == "a":  # several frames
            data = b"".join(zstandard.ZstdCompressor(level=3).compress(data[i:i + 5000]) for i in range(0, len(data), 5000))
            write(tmp_path / f"{name}.jsonl.zst", data)
        elif name[0] == "b":
            write(tmp_path / f"{name}.jsonl.gz", gzip.compress(data[:777]) + gzip.compress(data[777:]))
        else:
            write(tmp_path / f"{name}.jsonl", data)
    write(tmp_path / "empty.jsonl", b"")
    write(tmp_path / "_SUCCESS", b"no line\n")
    got = L.line_scan(spark, str(tmp_path)).collect()
    assert all(r["problem"] is None for r in got)
    found = {}
    for r in sorted(got, key=lambda r: (r["file"], r["number"])):
        found.setdefault(os.path.basename(r["file"]).split(".")[0], []).append(r["value"])
    assert found == made
    rows, problems = L.jsonl_any(spark, str(tmp_path), "id long, kind string, text string")
    assert rows.count() == 2400 and problems.count() == 0
    assert L.line_scan(spark, "file://" + str(tmp_path)).count() == 2400
    assert L.line_scan(spark, str(tmp_path / "c0.jsonl")).count() == 300


def test_damaged_files_are_reported(spark, tmp_path):
    data = "\n".join(json.dumps({"id": i, "x": random.Random(i).random()}) for i in range(20_000)).encode()
    whole = zstandard.ZstdCompressor(level=3).compress(data)
    write(tmp_path / "cut.jsonl.zst", whole[:len(whole) // 2])
    write(tmp_path / "broken.jsonl.zst", whole[:50_000] + bytes(200) + whole[50_200:])
    write(tmp_path / "cut.jsonl.gz", gzip.compress(data)[:90_000])
    write(tmp_path / "no.jsonl.gz", b"this is no gzip")
    write(tmp_path / "plain.jsonl", b'{"id": 1, "x": 2}\n{"id": \n\n{"id": 3, "x": 4}')
    rows, problems = L.jsonl_any(spark, str(tmp_path), "id long, x double")
    named = {(os.path.basename(r["file"]), r["problem"].split(":")[0]) for r in problems.collect()}
    assert {n for n, _ in named} == {"cut.jsonl.zst", "broken.jsonl.zst", "cut.jsonl.gz", "no.jsonl.gz", "plain.jsonl"}
    assert ("cut.jsonl.zst", "EOFError") in named and ("cut.jsonl.gz", "EOFError") in named and ("plain.jsonl", "no JSON") in named
    assert rows.where("id is null").count() == 0 and rows.count() > 10_000  # what stands before the damage


@pytest.mark.parametrize("compression", ["zstd", "gzip", "none"])
def test_shards_within_both_limits(spark, tmp_path, compression):
    r = random.Random(4)
    sizes = [r.choice([1, 5, 20, 20, 20, 60, 130, 260, 500, 980, 3000]) for _ in range(900)]
    rows = [(i // 2, i % 2, "x" * n) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "a long, b int, t string")

    def files(tasks, name):
        path = str(tmp_path / name)
        L.sharded_jsonl(df.repartition(tasks), path, ["a", "b"], 12, 1000, compression)
        out = {}
        for f in sorted(glob.glob(path + "/*")):
            with open(f, "rb") as s:
                out[os.path.basename(f)] = s.read()
        return path, out

    path, first = files(3, "one")
    assert list(first) == [f"part-{i:05d}.jsonl{L.SUFFIXES[compression]}" for i in range(len(first))]
    assert files(7, "two")[1] == first  # the same files, whatever the tasks
    held = {}
    for row in L.line_scan(spark, path).orderBy("file", "number").collect():
        held.setdefault(row["file"], []).append(row["value"])
    total = 0
    for values in held.values():
        size = sum(len(v.encode()) + 1 for v in values)
        assert len(values) <= 12 and (size <= 1000 or len(values) == 1)
        keys = [(json.loads(v)["a"], json.loads(v)["b"]) for v in values]
        assert keys == sorted(keys)
        total += size
    got = sorted((json.loads(v)["a"], json.loads(v)["b"], json.loads(v)["t"]) for values in held.values() for v in values)
    assert got == sorted(rows)
    assert len(held) < 3 * max(total / 1000, 900 / 12) + 5
    with pytest.raises(Exception, match="exists|Exists"):
        L.sharded_jsonl(df, path, ["a", "b"], 12, 1000, compression)


def test_no_rows_and_no_files(spark, tmp_path):
    df = spark.createDataFrame([], "a long, t string")
    L.sharded_jsonl(df, str(tmp_path / "none"), ["a"], 5, 100)
    assert L.line_scan(spark, str(tmp_path / "none")).count() == 0


def test_sums_of_shards_are_cut_though_a_class_is_small(spark, monkeypatch):
    from loomtab.operators import ordered

    sliced, cut = [], ordered._range_slices
    monkeypatch.setattr(ordered, "_range_slices", lambda df, by, *a: sliced.append(list(by)) or cut(df, by, *a))
    df = spark.range(300).selectExpr("id", "repeat('x', 20) AS v")
    got = sorted(L.sharded(df, ["id"], "v", 1000, 1 << 20).collect())
    assert ["_class"] in sliced and [r["id"] for r in got] == list(range(300)) and {r["shard"] for r in got} == {0}


def branches(top):
    """Lines of each file by folder, with the largest number of lines of a file."""
    found, most = {}, 0
    for f in glob.glob(f"{top}/*/*.txt"):
        with open(f, "rb") as stream:
            lines = stream.read().split(b"\n")
        assert lines.pop() == b""
        found.setdefault(os.path.basename(os.path.dirname(f)), []).extend(lines)
        most = max(most, len(lines))
    return {k: sorted(v) for k, v in found.items()}, most


def test_text_tree_is_that_of_the_partitioned_sink(spark, tmp_path):
    keys = ["en", "de", "a/b=c%d", "x y'\"[]{}^:*?#\\é漢", "", None, "EN", "\x01\x7f"]
    rows = [(keys[i % 8], None if i % 11 == 0 else "" if i % 7 == 0 else f"{i} é漢\r\t" * (i % 90)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v string").repartition(3)
    df.write.partitionBy("k").option("maxRecordsPerFile", 7).text(str(tmp_path / "plain"))
    L.text_tree_sink(df, f"file://{tmp_path}/tree", "k", "v", 7)
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.trees.link./t", f"file://{tmp_path}")
    L.text_tree_sink(df, "viewfs://trees/t/far", "k", "v", 7)
    found, most = branches(tmp_path / "plain")
    assert len(found) == 7 and most == 7
    assert branches(tmp_path / "tree") == branches(tmp_path / "far") == (found, most)
    assert not os.path.exists(tmp_path / "tree/_temporary")
    numbers = df.selectExpr("length(v) AS n", "v")
    numbers.write.partitionBy("n").text(str(tmp_path / "plain_n"))
    L.text_tree_sink(numbers, str(tmp_path / "tree_n"), "n", "v", 1000)
    assert branches(tmp_path / "tree_n") == branches(tmp_path / "plain_n")
    with pytest.raises(Exception, match="FileExistsError"):
        L.text_tree_sink(df, f"{tmp_path}/tree", "k", "v", 7)
    L.text_tree_sink(df.limit(0), f"{tmp_path}/none", "k", "v", 7)
    assert branches(tmp_path / "none") == ({}, 0)


def test_small_text_files_start_no_processes(spark, tmp_path):
    """Each file once cost four processes that set the modes of it and of its checksum file."""
    from loomtab.plans import load_all
    from loomtab.plans.registry import QUERIES

    load_all()
    lang = F.element_at(F.array(F.lit("en"), F.lit(None), F.lit("de")), (F.col("id") % 3 + 1).cast("int"))
    text = F.when(F.col("id") % 5 > 0, F.concat(F.lit("é\n\n漢 "), F.col("id").cast("string")))
    docs = spark.range(50_000).select(F.col("id").alias("doc_id"), text.alias("text"), lang.alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))

    def started():
        with open("/proc/stat") as f:
            return next(int(line.split()[1]) for line in f if line.startswith("processes"))

    before = started()
    got = {r["lang"]: (r["n_lines"], r["n_chars"]) for r in QUERIES["text_file_source"](spark, str(tmp_path)).collect()}
    assert started() - before < 2000  # 4 for each of 1,000 files before
    want = {}
    for i in range(50_000):
        name = ("en", "", "de")[i % 3]
        n, chars = want.get(name, (0, 0))
        want[name] = n + 1, chars + (len(f"é  漢 {i}") if i % 5 else 0)
    assert got == want
