import pytest
from pyspark.sql import functions as F

from surveyloom import functions as X
from surveyloom.operators.projection import (
    fill_int,
    nested_to_json,
    rename_map,
    select_existing,
    standard_name,
    standardize_columns,
    to_numeric,
)


def one(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_text_normalisation(spark):
    rows = [("  A\u0096b\t\n C  ",), (None,), (" X y ",)]
    assert one(spark, rows, "t string", X.normalize_text("t")) == [("a b c",), ("",), ("x y",)]
    assert one(spark, [(" Pase ",), (None,)], "t string", X.norm_cat("t")) == [("pase",), (None,)]
    assert one(spark, [("Código ÑANDÚ",)], "t string", X.strip_accents("t")) == [("Codigo NANDU",)]


def test_codes_never_shorten(spark):
    rows = [("40101",), ("040101",), ("0401011",), (None,)]
    got = one(spark, rows, "c string", X.zfill("c", 6), *X.code_levels(X.zfill("c", 6), [2, 4]))
    assert got == [("040101", "04", "0401"), ("040101", "04", "0401"), ("0401011", "04", "0401"), (None, None, None)]


def test_numbers_and_missing(spark):
    rows = [("12",), ("abc",), ("",), (None,), ("NaN",)]
    assert [r[0] for r in one(spark, rows, "t string", X.as_number("t"))] == [12.0, None, None, None, None]
    nums = [(1.0, 0.0), (float("nan"), 2.0), (None, 2.0), (6.0, 3.0), (6.0, None)]
    assert [r[0] for r in one(spark, nums, "a double, b double", X.ratio("a", "b"))] == [None, None, None, 2.0, None]
    assert [r[0] for r in one(spark, nums, "a double, b double", X.row_sum(["a", "b"]))] == [1.0, 2.0, 2.0, 9.0, 6.0]
    assert [r[0] for r in one(spark, nums, "a double, b double", X.count_positive(["a", "b"]))] == [1, 1, 1, 2, 1]
    assert one(spark, nums[:1], "a double, b double", X.row_sum([]), X.count_positive([])) == [(0.0, 0)]


def test_indicators_on_missing_are_zero(spark):
    rows = [("red publica, dentro", 1.0), (None, None), ("otro", float("nan"))]
    got = one(spark, rows, "t string, x double", X.flag_contains("t", "red publica"), X.flag_in("t", ["otro"]),
              X.flag_eq("t", "otro"), X.flag(X.as_number("x") >= 1), X.if_else(F.col("t").contains("otro"), "a", "b"))
    assert got == [(1, 0, 0, 1, "b"), (0, 0, 0, 0, "b"), (0, 1, 1, 0, "a")]
    # NaN is above every number in Spark; the numeric reading keeps it from counting
    assert one(spark, [(float("nan"),)], "x double", X.flag(X.as_number("x") >= 65)) == [(0,)]


def test_reported_answers(spark):
    rows = [("pase", None), (" Pase ", "none"), (None, ""), ("no", None), ("NAN", "Dolor")]
    got = one(spark, rows, "a string, b string", X.flag_reported("a"), X.any_reported(["a", "b"]), X.any_reported([]))
    assert got == [(0, 0, 0), (0, 0, 0), (0, 0, 0), (1, 1, 0), (1, 1, 0)]


def test_maps_labels_and_ids(spark):
    got = one(spark, [("hombre",), ("x",), (None,)], "t string", X.map_values("t", {"hombre": 1, "mujer": 0}))
    assert got == [(1,), (None,), (None,)]
    got = one(spark, [(1,), (5,), (None,)], "x int", X.label_rules([(F.col("x") < 3, "low"), (F.col("x") < 9, "mid")], "none"))
    assert got == [("low",), ("mid",), ("none",)]
    df = spark.createDataFrame([("040101", 7.0, None, " 3 "), (None, 2.5, 4, "z")], "u string, c double, v int, h string")
    ids = df.select(X.composite_id(df.columns, [f.dataType for f in df.schema.fields])).collect()
    assert [r[0] for r in ids] == ["040101_7_NA_3", "NA_2.5_4_z"]


def test_names(spark):
    assert standard_name("  aÑo ") == "ano"
    assert standard_name("Código CNO--2015 ") == "codigo_cno_2015"
    df, mapping = standardize_columns(spark.createDataFrame([(1, 2)], ["aÑo", "P-1"]), "t")
    assert df.columns == ["ano", "p_1"]
    assert [tuple(r) for r in mapping.collect()] == [("t", "aÑo", "ano"), ("t", "P-1", "p_1")]
    with pytest.raises(ValueError, match="collide"):
        standardize_columns(spark.createDataFrame([(1, 2)], ["Año", "ano"]))


def test_projection(spark):
    df = spark.createDataFrame([("1", None), ("x", 2.0)], "a string, b double")
    assert select_existing(df, ["b", "zz", "a", "b"]).columns == ["b", "a"]
    assert [r["a"] for r in to_numeric(df, ["a", "zz"]).collect()] == [1.0, None]
    assert [r["b"] for r in fill_int(df, ["b"], 9).collect()] == [9, 2]
    renamed, report = rename_map(df, {"a": "c", "q": "z"})
    assert renamed.columns == ["c", "b"] and report.filter("was_renamed").count() == 1
    with pytest.raises(ValueError, match="collide"):
        rename_map(df, {"a": "b"})


def test_nested_json_sorts_keys(spark):
    df = spark.sql("select map('b', 1, 'a', 2) as m, named_struct('z', 1, 'a', array(named_struct('y', 1, 'x', 2))) as s")
    row = nested_to_json(df).first()
    assert row["m"] == '{"a":2,"b":1}' and row["s"] == '{"a":[{"x":2,"y":1}],"z":1}'
