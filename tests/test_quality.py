import warnings

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from loomtab.functions import expr as X
from loomtab.operators import features as E, joins as J, metrics as M, quality as Q, splits as P, udfs as U
from loomtab.sources import files as S
from loomtab.sources.tables import nan_to_null

BASE = Q.Contract({"employee_id": "int", "name": "string"}, rules=(Q.at_least("employee_id", 0),))
STAFF = BASE.extend({"status": "string"}, nullable=["name"], rules=[Q.one_of("status", ["active", "inactive"])])


def _staff(spark, rows):
    return spark.createDataFrame(rows, "employee_id int, name string, status string")


def test_contract_inherits_and_holds(spark):
    df = _staff(spark, [(0, "a", "active"), (1, None, "inactive")])
    assert Q.enforce(df, STAFF) is df
    with pytest.raises(Q.ContractError):
        Q.enforce(df, BASE)  # here the name may not be NULL
    with pytest.raises(Q.ContractError, match="missing column status"):
        Q.enforce(df.drop("status"), STAFF)
    with pytest.raises(Q.ContractError, match="employee_id >= 0: 1 of 1"):
        Q.enforce(_staff(spark, [(-1, "a", "active")]), STAFF)


def test_warn_keeps_the_frame(spark):
    df = _staff(spark, [(1, "a", "gone")])
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        assert Q.enforce(df, STAFF, "warn") is df
    assert any("status" in str(w.message) for w in seen)


@settings(max_examples=8, deadline=None)
@given(rows=st.lists(st.tuples(st.integers(0, 99), st.text("ab", max_size=3), st.sampled_from(["active", "inactive"])), min_size=1, max_size=5))
def test_rows_drawn_from_the_contract_pass(spark, rows):
    assert STAFF.report(_staff(spark, rows)).where("not ok").isEmpty()


def test_missing_numbers_are_null(spark):
    df = nan_to_null(spark.createDataFrame([(1.0,), (float("nan"),)], "x double"))
    assert df.agg(F.count("x")).first()[0] == 1


def test_row_count_guard(spark):
    facts = spark.createDataFrame([(1,), (2,)], "k int")
    with pytest.raises(ValueError):
        J.checked_join(facts, spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string"), ["k"])


def test_vocabulary_error(spark):
    train = spark.createDataFrame([("a",), (None,), ("",)], "c string")
    vocab = E.vocabulary([train], "c")
    assert {r.c: r.code for r in vocab.collect()} == {None: 0, "": 1, "a": 2}
    with pytest.raises(Exception, match="not in the vocabulary"):
        E.lookup_code(spark.createDataFrame([("z",)], "c string"), vocab, "c", "code").collect()


def test_impute_rejects_other_methods(spark):
    with pytest.raises(ValueError):
        E.impute(spark.range(3), "guess")


def test_correlation_filter_keeps_target_relation(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0 + F.rand(1)).alias("b"), F.rand(2).alias("c"), (F.col("id") * 3.0).alias("y"))
    assert E.correlation_dropped(df, ["b", "a", "c"], "y") == ["b"]


def test_smote_values_lie_between_parents(spark):
    rows = [(i, float(i), float(i * i), 1 if i < 8 else 0) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, x double, z double, y int")
    made = P.smote(df, "y", "id", ["x", "z"], 3, 0.5, 1).where("synthetic").collect()
    assert len(made) == 26 - 8
    assert all(0 <= r.x <= 7 and 0 <= r.z <= 49 for r in made)
    assert P.smote(df, "y", "id", ["x", "z"], 8, 0.5, 1).count() == 60


def test_auc_on_ties_and_perfect_scores(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1)], "y int, p double")
    assert M.roc_auc(df, "y", "p").first()[0] == 0.875
    assert M.average_precision(df.where("p <> 0.5"), "y", "p").first()[0] == 1.0


def test_bad_lines(spark, tmp_path):
    path = str(tmp_path / "x.jsonl")
    with open(path, "w") as f:
        f.write('{"id": 1, "score": 0.5}\n{"id": 2, "sco\n\nnonsense\n{"id": 3, "score": 1.5}\n')
    good, bad = S.jsonl_split_bad(spark, path, "id long, score double")
    assert sorted(r.id for r in good.collect()) == [1, 3] and bad.count() == 2


def test_parsers(spark):
    lines = spark.createDataFrame([("@problemName x",), ("@data",), ("1.0,2.5,x:7",), ("# c",)], "value string")
    row = S.parse_series_lines(lines).first()
    assert row.series == [1.0, 2.5, None] and row.label == "7"
    fixed = spark.createDataFrame([("AB1  12.5",), ("AB2  n.a.",), ("short",)], "value string")
    assert [tuple(r) for r in S.parse_fixed_width(fixed, {"id": (0, 4, "string"), "v": (5, 9, "double")}).collect()] == [("AB1", 12.5)]


def test_names_must_not_collide():
    assert X.sanitized_names(["a b", "c-d"]) == ["a_b", "c_d"]
    with pytest.raises(ValueError):
        X.sanitized_names(["a b", "a-b"])


def test_map_items_raises_on_request(spark):
    df = spark.createDataFrame([(1, 0), (2, 4)], "id int, x int")
    kept = {r.id: (r.result, r.error) for r in U.map_items(df, "id", "x", lambda v, s: s / v, "double", s=8.0).collect()}
    assert kept[2] == (2.0, None) and kept[1][0] is None and "ZeroDivision" in kept[1][1]
    with pytest.raises(Exception):
        U.map_items(df, "id", "x", lambda v: 1 / v, "double", on_error="raise").collect()
