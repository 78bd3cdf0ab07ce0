"""Tables kept by batches: bounded reads, retries, snapshots that did not commit."""

import os
import random

from pyspark.sql import functions as F

from loomtab.operators.windows import top_per_group
from loomtab.streaming import streams as S


def merged(rows):
    out = {}
    for k, n, v in rows:
        a, b = out.get(k, (0, 0))
        out[k] = (a + n, b + v)
    return out


def batches(spark, count):
    r = random.Random(1)
    made = [[(r.choice([None, "a", "b", "c", f"k{i}"]), 1, float(r.randint(0, 99))) for _ in range(r.randint(1, 6))] for i in range(count)]
    return made, [spark.createDataFrame(b, "k string, n long, total double") for b in made]


def kept(spark, path, every=3):
    return S.KeptTable(spark, path, S._summary("k"), every)


def rows(df):
    return {r["k"]: (r["n"], r["total"]) for r in df.collect()}


def test_reads_do_not_grow(spark, tmp_path):
    path = str(tmp_path / "t")
    made, frames = batches(spark, 14)
    table = kept(spark, path)
    assert table.read() is None
    seen = []
    for i, df in enumerate(frames):
        table.add(df, i)
        assert rows(table.read()) == merged([x for b in made[:i + 1] for x in b])
        seen.append(len(os.listdir(path)))
        assert len(table.parts()) <= 3
    assert max(seen) <= 8  # two rounds of three batches and their snapshots


def test_a_retry_of_any_batch_gives_the_same_table(spark, tmp_path):
    made, frames = batches(spark, 8)
    for again in range(8):
        path = str(tmp_path / f"t{again}")
        table = kept(spark, path)
        for i, df in enumerate(frames):
            table.add(df, i)
            if i == again:
                kept(spark, path).add(df, i)
            assert rows(table.read()) == merged([x for b in made[:i + 1] for x in b])


def test_what_did_not_commit_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    made, frames = batches(spark, 6)
    table = kept(spark, path)
    for i, df in enumerate(frames[:5]):
        table.add(df, i)
    # The snapshot of batch 5 breaks off: rows are there, the mark is not; and half a batch folder as well.
    spark.createDataFrame([("x", 99, 1.0)], "k string, n long, total double").write.parquet(f"{path}/snapshot=5")
    os.remove(f"{path}/snapshot=5/_SUCCESS")
    spark.createDataFrame([("y", 99, 1.0)], "k string, n long, total double").write.parquet(f"{path}/batch=5")
    os.remove(f"{path}/batch=5/_SUCCESS")
    assert rows(table.read()) == merged([x for b in made[:5] for x in b])
    table.add(frames[5], 5)
    assert rows(table.read()) == merged([x for b in made for x in b])


def test_newest_rows_over_many_runs(spark, tables, tmp_path):
    events = tables.events.select("user_id", "ts", "value")
    landing, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    schema = "user_id long, ts timestamp, value double"
    got = None
    for i in range(10):
        events.where(F.pmod(F.xxhash64("ts"), F.lit(10)) == i).coalesce(1).write.mode("append").parquet(landing)
        got = S.latest_rows(S.arriving(spark, landing, schema), out, ck, "user_id", "ts")
    want = top_per_group(events, ["user_id"], [F.desc("ts")], 1)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert len(os.listdir(out)) <= 12


def test_windows_of_rows_over_batches_in_few_states(spark, tmp_path, monkeypatch):
    import random

    r = random.Random(3)
    landing, want, held = str(tmp_path / "in"), [], {}
    for batch in range(3):
        rows = [(r.choice([None, *range(40)]), 1000 * batch + i, r.choice([None, round(r.random(), 3)]) if r.random() < 0.1 else r.random()) for i in range(300)]
        spark.createDataFrame(rows, "k long, s long, v double").selectExpr("k", "timestamp_seconds(s) AS ts", "v").coalesce(1).write.mode("append").parquet(landing)
        for k, s, v in rows:
            held[k] = [*held.get(k, []), v][-4:]
            want.append((k, s, None if None in held[k] else round(sum(held[k]) / len(held[k]), 9)))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    S.append_run(S.row_window_mean(S.arriving(spark, landing, "k long, ts timestamp, v double", 1), "k", "ts", "v", 4), out, ck)
    got = [(q["k"], q["s"], None if q["mean"] is None else round(q["mean"], 9)) for q in spark.read.parquet(out).selectExpr("k", "unix_seconds(ts) AS s", "mean").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_states_do_not_grow_with_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "LOTS", 5)
    landing, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    spark.range(200).selectExpr("id AS k", "timestamp_seconds(id) AS ts", "1.0D AS v").write.parquet(landing)
    S.append_run(S.row_window_mean(S.arriving(spark, landing, "k long, ts timestamp, v double"), "k", "ts", "v", 4), out, ck)
    assert spark.read.format("statestore").load(ck).count() == 5 and spark.read.parquet(out).count() == 200
