import pytest
from pyspark.sql import functions as F

from surveyloom.operators import filters as FL
from surveyloom.operators import joins as J
from surveyloom.operators import profile as P
from surveyloom.operators import quality as Q
from surveyloom.operators import reshape as R


def test_prefix_filter(spark):
    rows = [("40101",), ("040101",), ("0401011",), ("150101",), (None,), ("4",)]
    df = spark.createDataFrame(rows, "ubigeo string")
    kept, audit = FL.filter_prefix(df, "ubigeo", "04", "t")
    assert sorted(r[0] for r in kept.collect()) == ["040101", "040101", "0401011"]
    row = audit.first()
    assert (row["before_rows"], row["after_rows"], row["codes_left"]) == (6, 3, ["04"])
    same, audit = FL.filter_prefix(df, "absent", "04", "t")
    assert same.count() == 6 and audit.first()["has_code"] is False


def test_prefix_filter_is_pushed_to_the_scan(spark, data):
    df = spark.read.parquet(f"{data}/customer.parquet")
    plan = FL.filter_prefix(df, "c_mktsegment", "BU", width=2)[0]._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(c_mktsegment,BU)" in plan


def test_drop_null_target(spark):
    df = spark.createDataFrame([("1",), ("0",), (None,), ("x",)], "y string")
    kept, audit = FL.drop_null_target(df, "y")
    assert sorted(r[0] for r in kept.collect()) == [0, 1]
    assert tuple(audit.first()) == (4, 1, 1, 2)


def test_merge_rejects_duplicates(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    addon = spark.createDataFrame([(1, 5, "z")], "k int, y int, x string")
    merged, audit = J.merge_with_audit(base, addon, ["k"], "m")
    assert merged.columns == ["k", "x", "y"]
    assert [tuple(r) for r in merged.orderBy("k").collect()] == [(1, "a", 5), (2, "b", None)]
    assert tuple(audit.first()) == ("m", 2, 1, 2, 0, "y")
    with pytest.raises(Exception, match="not unique"):
        J.merge_with_audit(base, addon.union(addon), ["k"], "m")[0].collect()
    with pytest.raises(Exception, match="not unique"):
        J.merge_with_audit(base.union(base), addon, ["k"], "m")[0].select("x").collect()


def test_mark_and_lookup(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    keys = spark.createDataFrame([(1,), (1,)], "k int")
    assert [tuple(r) for r in J.mark_exists(a, keys, ["k"], "f").orderBy("k").collect()] == [(1, 1), (2, 0)]
    s1 = spark.createDataFrame([(1, None), (2, "s1")], "id int, v string")
    s2 = spark.createDataFrame([(1, "s2"), (2, "no")], "id int, v string")
    out = J.lookup_first(a, [(s1, "id", "v", "k"), (s2, "id", "v", "k")], "v", F.lit("d"))
    assert [r["v"] for r in out.orderBy("k").collect()] == ["s2", "s1"]


def messy(spark):
    nan = float("nan")
    return spark.createDataFrame(
        [(1, 1.0, "a", 0, None), (2, nan, None, 1, None), (3, None, "a", 1, None), (4, 4.0, "b", 0, None)],
        "id int, x double, c string, y int, empty double").withColumn("fixed", F.lit("k"))


def test_profile(spark):
    got = {r["variable"]: r for r in P.profile_columns(messy(spark)).collect()}
    assert (got["x"]["null_count"], got["x"]["null_pct"], got["x"]["n_unique"]) == (2, 50.0, 2)
    assert (got["empty"]["null_count"], got["empty"]["n_unique"]) == (4, 0)
    assert (got["c"]["null_count"], got["c"]["n_unique"], got["c"]["dtype"]) == (1, 2, "string")
    kinds = {r["variable"]: r["feature_type"] for r in Q.classify_features(messy(spark), skip=["id"]).collect()}
    assert kinds == {"x": "numeric", "c": "categorical", "y": "binary", "empty": "binary", "fixed": "categorical"}
    left, report = Q.drop_constant(messy(spark))
    assert left.columns == ["id", "x", "c", "y"]
    assert {tuple(r) for r in report.collect()} == {("empty", "all_null"), ("fixed", "constant")}


def test_constant_with_missing_is_not_constant(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    assert Q.drop_constant(df)[0].columns == ["x"]


def test_correlation_uses_complete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0), (4.0, 9.0, 5.0)],
                               "a double, b double, k double")
    wide = P.corr_pairs(df, ["a", "b", "k"], 0.0).collect()
    moments = P._pair_moments(df, ["a", "b", "k"]).filter("corr is not null").collect()
    assert len(wide) == len(moments) == 1
    assert wide[0]["corr"] == pytest.approx(moments[0]["corr"], abs=1e-12)
    import numpy as np
    assert wide[0]["corr"] == pytest.approx(np.corrcoef([1, 2, 4], [2, 4, 9])[0, 1], abs=1e-12)


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(2.0, 0), (2.0, 1)], "x double, y int")
    assert {(r["bin"], r["n"]) for r in P.histogram(df, "x", "y").collect()} == {(1, 1)}


def test_summaries(spark):
    row = P.categorical_summary(messy(spark), ["c"]).first()
    assert (row["n_categories"], row["top_category"], row["top_n"], row["missing_pct"]) == (3, "a", 2, 25.0)
    summary = {r["variable"]: r for r in P.numeric_summary(messy(spark), ["x", "empty"]).collect()}
    assert summary["x"]["median"] == 2.5 and summary["x"]["missing_pct"] == 50.0
    assert summary["empty"]["count"] == 0 and summary["empty"]["median"] is None
    assert P.rows_with_missing(messy(spark).drop("empty")).first()["with_missing"] == 2
    rare = P.rare_categories(messy(spark), ["c"]).first()["rare_categories"]
    assert rare == ["a", "<NA>", "b"]


def test_duplicates_and_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert Q.duplicate_rows(df).first()[0] == 1
    audit = {r["candidate_key"]: (r["duplicate_count"], r["is_unique"]) for r in
             Q.key_audit(df, [["k"], ["k", "v"], ["zz"]], "t").collect()}
    assert audit == {"k": (2, False), "k|v": (1, False)}
    with pytest.raises(ValueError):
        Q.assert_unique(df, ["k"])


def test_dummies_have_a_missing_level(spark):
    wide, meta = R.expand_dummies(messy(spark), ["c"], ["id"])
    assert wide.columns == ["id", "c__<NA>", "c__a", "c__b"]
    assert {r["level"]: r["n"] for r in meta.collect()} == {"<NA>": 1, "a": 2, "b": 1}
    ones = {(r["id"], n) for r in wide.collect() for n in wide.columns[1:] if r[n] == 1}
    assert {(r["id"], r["expanded_feature"]) for r in R.long_dummies(messy(spark), ["c"], ["id"]).collect()} == ones


def test_concepts_without_hits(spark):
    df = spark.createDataFrame([("Nivel de AGUA", "1"), ("agua potable", "9"), ("luz", "9")], "label string, m string")
    got = sorted(tuple(r) for r in Q.concept_search(
        df, "label", {"water": ["agua", "rio"], "light": ["luz"]}, F.col("m") == "1").collect())
    assert got == [("light", "luz", 0, 0, "no_direct_equivalent"), ("light", "luz", 1, 0, "outside_universe"),
                   ("water", "agua", 2, 1, "ok"), ("water", "rio", 0, 0, "no_results")]


def test_csv_with_byte_order_mark_keeps_codes(spark, tmp_path):
    from surveyloom.sources import read_csv, read_first, read_json

    path = tmp_path / "t.csv"
    path.write_bytes("﻿ubigeo,x\n040101,1.5\n,\n".encode())
    rows = read_csv(spark, str(path), "ubigeo string, x double").collect()
    assert [tuple(r) for r in rows] == [("040101", 1.5), (None, None)]
    assert read_first(spark, str(path), "absent", "ubigeo string, x double").count() == 2
    assert read_json(spark, str(tmp_path / "none.json"), "a int").count() == 0


def test_profile_of_a_wide_table(spark):
    df = spark.range(5).select(*[(F.col("id") * i).cast("double").alias(f"c{i}") for i in range(230)])
    assert P.column_shapes(df).filter("is_constant").collect()[0]["variable"] == "c0"
    assert P.null_percent(df).count() == 230


def test_employment_rollup_bounds_rows_per_task(spark, monkeypatch):
    """Rows meet the heads in partitions of a bounded number of rows, however well they compress."""
    from surveyloom.operators import rollup as U

    monkeypatch.setattr(U, "UNIT_ROWS", 10, raising=False)
    people = spark.createDataFrame([(i // 4, i % 4, float(i % 3)) for i in range(400)] + [(None, 1, 5.0), (7, None, 5.0), (7, 1, 5.0)],
                                   "home int, person int, pay double")
    heads = spark.createDataFrame([(i, 1) for i in range(100)], "home int, person int")
    out = U.rollup_employment(people, heads, ["home"], "person", ["pay"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
    got = {r["home"]: tuple(r)[1:] for r in out.collect()}
    assert got[None] == (1, 1, 0, 1) and got[7] == (4, 5, 1, 1) and got[1] == (4, 3, 1, 1) and len(got) == 101
