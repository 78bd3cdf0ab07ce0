"""Hand cases for answers that were once wrong, and for plans that must not depend on a size estimate."""

from pyspark.sql import functions as F

from support import same
from loomtab import session
from loomtab.operators import retrieval as V, splits as P, text as T
from loomtab.sources import files as S
from loomtab.streaming import streams as st


def test_near_the_date_line_and_the_pole(spark):
    df = spark.createDataFrame([(1, 0.0, -179.9), (2, 0.0, 179.9), (3, 89.5, 0.0), (4, 0.0, 0.0), (5, 10.0, -179.9), (6, -89.9, 77.0)], "id int, lat double, lon double")

    def near(at, km):
        return sorted(r.id for r in df.where(V.within_km("lat", "lon", at, km)).collect())

    assert near((0.0, 179.95), 50) == [1, 2]
    assert near((0.0, -179.95), 50) == [1, 2]
    assert near((89.5, 180.0), 200) == [3]
    assert near((-90.0, 0.0), 50) == [6]
    assert near((0.0, 0.0), 1) == [4]


def test_box_never_loses_a_row(spark):
    df = spark.range(4000).select(F.degrees(F.asin(F.rand(1) * 2 - 1)).alias("lat"), (F.rand(2) * 360 - 180).alias("lon")).cache()
    for at, km in (((60.0, 179.0), 900), ((-85.0, -170.0), 700), ((5.0, 20.0), 3000)):
        exact = V.haversine_miles("lat", "lon", F.lit(at[0]), F.lit(at[1])) * 1.609344 <= km
        assert df.where(V.within_km("lat", "lon", at, km)).count() == df.where(exact).count() > 0


def test_mark_inside_a_header(spark, tmp_path):
    (tmp_path / "a.fasta").write_text(">seq1 A->B mutation\nATG\nCC\n>seq2\nGG\n")
    got = {r.record_id: r.sequence for r in S.fasta_scan(spark, str(tmp_path / "a.fasta")).collect()}
    assert got == {"seq1 A->B mutation": "ATGCC", "seq2": "GG"}


def test_heartbeat_keeps_groups_of_null(spark, tmp_path):
    schema, path = "ts timestamp, k string, v double, u long", str(tmp_path / "in")
    rows = [("2024-01-01 00:10:00", None, 2.0, 1), ("2024-01-01 00:20:00", "a", 3.0, 1)]
    spark.createDataFrame(rows, "ts string, k string, v double, u long").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(path)
    st.heartbeat(spark, path, schema, "ts", "2030-01-01")
    stream = st.arriving(spark, path, st.with_beat(schema), 1)
    st.append_run(st.tumbling(stream, "ts", ["k", st.BEAT], "v", "u", "1 hour", "1 hour"), str(tmp_path / "out"), str(tmp_path / "ck"))
    got = spark.read.parquet(str(tmp_path / "out")).where(F.col(st.BEAT).isNull()).collect()
    assert sorted((str(r.k), r.total) for r in got) == [("None", 2.0), ("a", 3.0)]


def test_page_events():
    page = "<p>a &lt; b<!-- x --> c</p><script>if (a<b) '</p>'</script><a HREF='/x'>l</a><nav>menu</nav>tail"
    assert T._visible(page) == ["a < b", "c", "l", "tail"]
    assert T._targets(page + "<a href=//o.p/q/#z><a href='http://[bad'>", "http://h.i/j") == ["http://h.i/x", "http://o.p/q"]


def test_fraction_is_repeatable(tables):
    one = P.sample_fraction(tables.orders, "o_orderkey", 0.3, 5)
    same(one, P.sample_fraction(tables.orders.repartition(7), "o_orderkey", 0.3, 5))
    n = tables.orders.count()
    assert 0.2 * n < one.count() < 0.4 * n and P.sample_fraction(tables.orders, "o_orderkey", 1.0, 5).count() == n


def test_no_size_estimate_is_read():
    import inspect

    assert "sizeInBytes" not in inspect.getsource(session) and not hasattr(session, "is_small")


def test_checkpoint_folder_of_the_session_is_used(spark):
    folder = session.shared_dir(spark)
    assert session.scratch(spark, "x").startswith(folder)


