"""Scans, sinks, inventories and nested catalogs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import normalize_text
from ..operators.filters import filter_catalog
from ..operators.nested import explode_matrix, flatten_catalog, prefer, prune_catalog
from ..operators.ordered import sample_head
from ..operators.projection import nested_to_json
from ..session import ensure_checkpoint_dir
from ..sources import (
    expected_manifest,
    file_inventory,
    read_csv,
    read_first,
    read_json,
    read_table,
    schema_summary,
    write_audit,
    write_table,
)
from .registry import query


def scratch(df: DataFrame, name: str) -> str:
    """A new folder next to the checkpoints, which all executors can reach."""
    return f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- files

@query("a01_parquet_scan", """
    SELECT l_returnflag, COUNT(*) AS n_rows, CAST(SUM(l_linenumber) AS BIGINT) AS line_total
    FROM lineitem GROUP BY l_returnflag""")
def _(t):
    folder = t._folder
    df = read_table(t._spark, f"{folder}/lineitem.parquet")
    return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_linenumber").alias("line_total"))


CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string, code string"


@query("a02_csv_scan", """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS code
    FROM customer""")
def _(t):
    df = t.customer.withColumn("code", F.lpad(F.col("c_custkey").cast("string"), 6, "0"))
    path = scratch(df, "csv")
    write_table(df, path, "csv")
    return read_csv(t._spark, path, CUSTOMER)


@query("a02b_csv_preferred_else_parquet", """
    SELECT c_custkey, c_name, c_acctbal FROM customer""")
def _(t):
    path = scratch(t.customer, "absent")
    return read_first(t._spark, path, f"{t._folder}/customer.parquet", CUSTOMER).select("c_custkey", "c_name", "c_acctbal")


@query("a03_json_records", """
    SELECT o_orderstatus AS step, COUNT(*) AS n_rows, COUNT(*) > 0 AS passed FROM orders GROUP BY o_orderstatus""")
def _(t):
    records = t.orders.groupBy(F.col("o_orderstatus").alias("step")).agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "passed", F.col("n_rows") > 0)
    path = scratch(records, "json")
    write_audit(records, path)
    schema = "step string, n_rows bigint, passed boolean"
    found = read_json(t._spark, path, schema, multi_line=False)
    return found.unionByName(read_json(t._spark, path + "-absent", schema))


@query("a04_parquet_sink", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def _(t):
    df = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    path = scratch(df, "parquet")
    write_table(df, path, "parquet", partition_by=["o_orderpriority"])
    return read_table(t._spark, path)


@query("a05_audit_sink", """
    SELECT 'orders' AS table_name, COUNT(*) AS n_rows, COUNT(DISTINCT o_custkey) AS n_customers FROM orders""")
def _(t):
    audit = t.orders.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_custkey").alias("n_customers")).select(
        F.lit("orders").alias("table_name"), "n_rows", "n_customers")
    path = scratch(audit, "audit")
    write_audit(audit, path)
    return read_json(t._spark, path, audit.schema, multi_line=False)


@query("a06_file_inventory", """
    SELECT n || '.parquet' AS file_name, CASE WHEN n = 'not_delivered' THEN 'missing' ELSE 'ok' END AS status,
           n <> 'not_delivered' AS has_size FROM (SELECT unnest(['region', 'nation', 'customer', 'supplier', 'part', 'orders',
      'lineitem', 'events', 'documents', 'embeddings', 'pages', 'benchmark', 'labels', 'conversations', 'not_delivered']) AS n)""")
def _(t):
    names = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
             "labels conversations not_delivered").split()
    expected = t._spark.createDataFrame([(f"{n}.parquet",) for n in names], "file_name string")
    found = file_inventory(t._spark, t._folder, expected)
    return found.select("file_name", "status", (F.coalesce("size_bytes", F.lit(0)) > 0).alias("has_size"))


def nested_parts(t) -> DataFrame:
    """One nested catalog entry per part: years → periods → modules."""
    p = F.col("p_partkey")

    def module(i: int):
        return F.struct(
            (F.col("p_size") + i).cast("string").alias("module_code"),
            F.concat_ws("-", "p_name", F.lit(i)).alias("module_name"),
            F.when(p % 2 == 0, F.concat(F.lit("C"), p, F.lit(f"_{i}"))).otherwise("").alias("csv_code"),
            F.when((p + i) % 3 == 0, F.concat(F.lit("S"), p, F.lit(f"_{i}"))).alias("stata_code"),
            F.when(p % 5 == 0, F.concat(F.lit("P"), p, F.lit(f"_{i}"))).alias("spss_code"))

    def period(*ids: int):
        return F.struct(F.col("p_size").alias("period_value"), F.array(*[module(i) for i in ids]).alias("modules"))

    years = F.create_map(F.lit("2022"), F.create_map(F.lit("Anual"), period(0)),
                         F.lit("2023"), F.create_map(F.lit("Anual"), period(0, 1), F.lit("Trimestre"), period(2)))
    return t.part.select(F.col("p_brand").alias("category"), F.col("p_partkey").cast("string").alias("survey_value"),
                         F.concat_ws(" ", "p_type", "p_name").alias("label"), years.alias("years"))


FLAT = """
    SELECT p_brand AS category, CAST(p_partkey AS VARCHAR) AS survey_value, p_type || ' ' || p_name AS label,
           y AS year, per AS period_label, p_size AS period_value, CAST(p_size + i AS VARCHAR) AS module_code,
           p_name || '-' || i AS module_name,
           CASE WHEN p_partkey % 2 = 0 THEN 'C' || p_partkey || '_' || i ELSE '' END AS csv_code,
           CASE WHEN (p_partkey + i) % 3 = 0 THEN 'S' || p_partkey || '_' || i END AS stata_code,
           CASE WHEN p_partkey % 5 = 0 THEN 'P' || p_partkey || '_' || i END AS spss_code
    FROM part, (VALUES ('2022', 'Anual', 0), ('2023', 'Anual', 0), ('2023', 'Anual', 1), ('2023', 'Trimestre', 2))
         AS v(y, per, i)"""
PICK = """coalesce(stata_code, nullif(csv_code, ''), spss_code)"""
SOURCE = """CASE WHEN stata_code IS NOT NULL THEN 'STATA' WHEN csv_code <> '' THEN 'CSV'
            WHEN spss_code IS NOT NULL THEN 'SPSS' END"""
FORMATS = {"STATA": "stata_code", "CSV": "csv_code", "SPSS": "spss_code"}


@query("a07_expected_manifest", f"""
    SELECT survey_value, year, period_label, module_code, module_name, {PICK} AS download_code,
           {SOURCE} AS download_format, {PICK} || '.zip' AS file_name FROM ({FLAT})""")
def _(t):
    out = expected_manifest(flatten_catalog(nested_parts(t)), FORMATS)
    return out.select("survey_value", "year", "period_label", "module_code", "module_name", "download_code",
                      "download_format", "file_name")


@query("a08_sample_head", """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_custkey, o_orderkey LIMIT 5""")
def _(t):
    return sample_head(t.orders, 5, ["o_custkey", "o_orderkey"]).select("o_orderkey", "o_custkey", "o_totalprice")


GRAINS = [({"l_orderkey", "l_linenumber"}, "person", "aggregate_to_household"),
          ({"o_orderkey", "o_custkey"}, "household", "direct_merge"),
          ({"p_partkey"}, "classification", "support_table")]


@query("a09_schema_summary", """
    SELECT 'lineitem' AS table_name, 11 AS columns, 'person' AS grain, 'aggregate_to_household' AS merge_strategy,
           COUNT(*) AS rows FROM lineitem
    UNION ALL SELECT 'orders', 6, 'household', 'direct_merge', COUNT(*) FROM orders
    UNION ALL SELECT 'part', 6, 'classification', 'support_table', COUNT(*) FROM part
    UNION ALL SELECT 'events', 6, 'unknown', 'manual_review', COUNT(*) FROM events""")
def _(t):
    tables = {n: getattr(t, n) for n in ("lineitem", "orders", "part", "events")}
    return schema_summary(tables, GRAINS, ("unknown", "manual_review"))


# ---------------------------------------------------------------- nested data

@query("n01_flatten_catalog", FLAT)
def _(t):
    return flatten_catalog(nested_parts(t))


@query("n02_preferred_format", f"""
    SELECT survey_value, year, period_label, module_code, {PICK} AS preferred_code, {SOURCE} AS preferred_format,
           {PICK} IS NOT NULL AS is_available FROM ({FLAT})""")
def _(t):
    return prefer(flatten_catalog(nested_parts(t)), FORMATS).select(
        "survey_value", "year", "period_label", "module_code", "preferred_code", "preferred_format", "is_available")


@query("n03_prune_catalog", f"""
    SELECT * FROM ({FLAT}) WHERE lower(label) LIKE '%promo%' AND lower(label) NOT LIKE '%red%' AND year = '2023'
      AND lower(period_label) LIKE '%anual%' AND module_code IN ('5', '10', '20', '40')""")
def _(t):
    pruned = prune_catalog(
        nested_parts(t), entry=normalize_text("label").contains("promo") & ~normalize_text("label").contains("red"),
        year=lambda y: y == "2023", period=lambda p: normalize_text(p).contains("anual"),
        module=lambda m: m["module_code"].isin("5", "10", "20", "40"))
    return flatten_catalog(pruned)


@query("n04_explode_matrix", """
    SELECT p_partkey, r.i AS row, c.i AS "column",
           CASE WHEN r.i = 0 AND c.i = 0 THEN p_size WHEN r.i = 0 THEN CAST(p_partkey % 7 AS INTEGER)
                WHEN c.i = 0 THEN CAST(p_partkey % 11 AS INTEGER) ELSE p_size * 2 END AS value
    FROM part, (VALUES (0), (1)) AS r(i), (VALUES (0), (1)) AS c(i)""")
def _(t):
    p = F.col("p_partkey")
    text = F.to_json(F.array(F.array(F.col("p_size").cast("bigint"), p % 7), F.array(p % 11, F.col("p_size") * 2)))
    return explode_matrix(t.part.select("p_partkey", text.alias("matrix")), "matrix")


@query("c03_filter_catalog", f"""
    SELECT survey_value, year, period_label, module_code, label FROM ({FLAT})
    WHERE lower(label) LIKE '%economy%' AND lower(label) NOT LIKE '%blue%' AND year = '2023'
      AND lower(period_label) LIKE '%anual%' AND module_code IN ('1', '2', '3', '4', '5')""")
def _(t):
    flat = flatten_catalog(nested_parts(t))
    return filter_catalog(flat, contains={"label": "economy", "period_label": "anual"}, not_contains={"label": "blue"},
                          equals={"year": "2023"}, code=("module_code", ["1", "2", "3", "4", "5"])).select(
        "survey_value", "year", "period_label", "module_code", "label")


@query("b24_nested_to_json", """
    SELECT p_partkey, '{"a_size":' || p_size || ',"z_brand":"' || p_brand || '"}' AS attributes,
           '{"a":' || p_size || ',"b":' || (p_partkey % 3) || '}' AS counts FROM part""")
def _(t):
    nested = t.part.select(
        "p_partkey", F.struct(F.col("p_brand").alias("z_brand"), F.col("p_size").alias("a_size")).alias("attributes"),
        F.create_map(F.lit("b"), F.col("p_partkey") % 3, F.lit("a"), F.col("p_size").cast("bigint")).alias("counts"))
    return nested_to_json(nested)
