"""Scalar expressions, projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ..functions import (
    any_reported,
    as_number,
    between,
    code_levels,
    composite_id,
    count_positive,
    flag_all,
    flag_contains,
    flag_eq,
    flag_in,
    flag_reported,
    if_else,
    label_rules,
    map_values,
    norm_cat,
    normalize_text,
    ratio,
    row_sum,
    zfill,
)
from ..operators.derive import Indicator, derive_indicators, programme_totals
from ..operators.filters import drop_null_target, filter_all, filter_prefix, metric_floor, semi_keep
from ..operators.projection import (
    fill_int,
    rename_map,
    select_existing,
    standardize_columns,
    storage_safe,
    to_numeric,
)
from .registry import query

ODD_NAMES = ["Código  Pieza", "p_NAME ", "Märke", "Tipo (p)", "TAMAÑO", "p-retail.price"]


@query("b01_standardize_columns", """
    SELECT p_partkey AS codigo_pieza, p_name, p_brand AS marke, p_type AS tipo_p, p_size AS tamano,
           p_retailprice AS p_retail_price FROM part""")
def _(t):
    return standardize_columns(t.part.toDF(*ODD_NAMES), "part")[0]


@query("b02_normalize_text", r"""
    SELECT doc_id, lower(trim(regexp_replace(replace(coalesce(text, ''), chr(150), ' '),
           '[\s\p{Z}\x0B\x1c-\x1f\x{85}]+', ' ', 'g'))) AS text_norm FROM documents""")
def _(t):
    return t.documents.select("doc_id", normalize_text("text").alias("text_norm"))


@query("b03_norm_cat", """
    SELECT o_orderkey, lower(trim('  ' || nullif(o_orderpriority, '5-LOW') || ' ')) AS priority FROM orders""")
def _(t):
    odd = F.concat(F.lit("  "), F.nullif("o_orderpriority", F.lit("5-LOW")), F.lit(" "))
    return t.orders.select("o_orderkey", norm_cat(odd).alias("priority"))


CODE = "lpad(CAST(o_custkey AS VARCHAR), 6, '0')"
LONG_CODE = "CAST(o_custkey * 10000 AS VARCHAR)"


@query("b04_zfill", f"""
    SELECT o_orderkey, {CODE} AS code,
           CASE WHEN length({LONG_CODE}) < 6 THEN lpad({LONG_CODE}, 6, '0') ELSE {LONG_CODE} END AS long_code
    FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", zfill("o_custkey", 6).alias("code"), zfill(col("o_custkey") * 10000, 6).alias("long_code"))


@query("b05_code_levels", f"""
    SELECT o_orderkey, substr({CODE}, 1, 2) AS department, substr({CODE}, 1, 4) AS province, {CODE} AS district
    FROM orders""")
def _(t):
    dep, prov, dist = code_levels(zfill("o_custkey", 6), [2, 4, 6])
    return t.orders.select("o_orderkey", dep.alias("department"), prov.alias("province"), dist.alias("district"))


@query("b06_to_numeric", """
    SELECT l_orderkey, l_linenumber, TRY_CAST(l_returnflag AS DOUBLE) AS flag_number,
           TRY_CAST(l_quantity || CASE WHEN l_linestatus = 'F' THEN '' ELSE 'x' END AS DOUBLE) AS quantity_number
    FROM lineitem""")
def _(t):
    text = t.lineitem.select("l_orderkey", "l_linenumber", col("l_returnflag").alias("flag_number"), F.concat(
        col("l_quantity").cast("string"), F.when(col("l_linestatus") == "F", "").otherwise("x")).alias("quantity_number"))
    return to_numeric(text, ["flag_number", "quantity_number", "not_there"])


@query("b07_map_values", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS status_code FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", map_values("o_orderstatus", {"F": 1, "O": 0}).alias("status_code"))


@query("b08_label_rules", """
    SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'RADAR'
           WHEN o_orderpriority = '2-HIGH' AND o_totalprice > 250000 THEN 'BALANCE'
           ELSE substr(o_orderpriority, 1, 1) || '-' || o_orderstatus END AS alias FROM orders""")
def _(t):
    pr = col("o_orderpriority")
    return t.orders.select("o_orderkey", label_rules([
        ((pr == "1-URGENT") & (col("o_orderstatus") == "F"), "RADAR"),
        ((pr == "2-HIGH") & (col("o_totalprice") > 250000), "BALANCE")],
        F.concat(F.substring(pr, 1, 1), F.lit("-"), col("o_orderstatus"))).alias("alias"))


@query("b09_b15_indicator_flags", """
    WITH j AS (SELECT o.o_orderkey, o.o_totalprice, nullif(o.o_orderpriority, '5-LOW') AS pr,
                      nullif(o.o_orderstatus, 'P') AS st FROM orders o)
    SELECT o_orderkey,
      CAST(coalesce(pr IN ('1-URGENT', '2-HIGH'), false) AS INTEGER) AS in_set,
      CAST(coalesce(contains(pr, 'HIGH'), false) AS INTEGER) AS has_text,
      CAST(coalesce(st = 'F', false) AS INTEGER) AS equals_f,
      CAST(coalesce(pr IN ('1-URGENT', '2-HIGH'), false) AND coalesce(st = 'F', false) AS INTEGER) AS proxy,
      CASE WHEN contains(pr, 'HIGH') THEN 'rural' ELSE 'urban' END AS area,
      CAST(coalesce(pr IS NOT NULL AND lower(trim(pr)) NOT IN ('3-medium'), false) AS INTEGER) AS reported,
      CAST(coalesce(st IS NOT NULL AND lower(trim(st)) NOT IN ('o', 'none', ''), false)
           OR coalesce(pr IS NOT NULL AND lower(trim(pr)) NOT IN ('o', 'none', ''), false) AS INTEGER) AS any_answer
    FROM j""")
def _(t):
    j = t.orders.select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("pr"),
                        F.nullif("o_orderstatus", F.lit("P")).alias("st"))
    high = flag_in("pr", ["1-URGENT", "2-HIGH"])
    return j.select("o_orderkey", high.alias("in_set"), flag_contains("pr", "HIGH").alias("has_text"),
                    flag_eq("st", "F").alias("equals_f"), flag_all([high, flag_eq("st", "F")]).alias("proxy"),
                    if_else(col("pr").contains("HIGH"), "rural", "urban").alias("area"),
                    flag_reported("pr", ["3-medium"]).alias("reported"),
                    any_reported(["st", "pr"], ["o", "none", ""]).alias("any_answer"))


@query("b11_column_comparison", """
    SELECT l_orderkey, l_linenumber, CAST(l_quantity = l_linenumber AS INTEGER) AS equal_columns,
           CAST(l_tax <= l_discount AS INTEGER) AS tax_leq_discount FROM lineitem""")
def _(t):
    from ..functions import flag

    return t.lineitem.select("l_orderkey", "l_linenumber", flag_eq("l_quantity", col("l_linenumber")).alias("equal_columns"),
                             flag(col("l_tax") <= col("l_discount")).alias("tax_leq_discount"))


@query("b16_b19_numeric_rows", """
    SELECT l_orderkey, l_linenumber,
      CAST(l_discount > 0 AS INTEGER) + CAST(l_tax > 0 AS INTEGER)
        + CAST(coalesce(TRY_CAST(l_returnflag AS DOUBLE) > 0, false) AS INTEGER) AS n_positive,
      round(l_quantity / nullif(l_discount, 0), 6) AS per_discount,
      round(l_discount + l_tax + coalesce(TRY_CAST(l_returnflag AS DOUBLE), 0), 6) AS total,
      CAST(coalesce(nullif(l_tax, 0), 7) AS INTEGER) AS filled FROM lineitem""")
def _(t):
    li = t.lineitem.withColumn("filled", F.nullif("l_tax", F.lit(0.0)))
    return fill_int(li, ["filled"], 7).select(
        "l_orderkey", "l_linenumber", count_positive(["l_discount", "l_tax", "l_returnflag"]).alias("n_positive"),
        F.round(ratio("l_quantity", "l_discount"), 6).alias("per_discount"),
        F.round(row_sum(["l_discount", "l_tax", "l_returnflag"]), 6).alias("total"), "filled")


@query("b20_composite_id", """
    SELECT l_orderkey || '_' || coalesce(CAST(nullif(l_linenumber, 7) AS VARCHAR), 'NA') || '_'
           || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '_' || trim(l_returnflag) AS unit_id FROM lineitem""")
def _(t):
    df = t.lineitem.withColumn("line", F.nullif("l_linenumber", F.lit(7)))
    cols = ["l_orderkey", "line", "l_quantity", "l_returnflag"]
    return df.select(composite_id(cols, [df.schema[c].dataType for c in cols]).alias("unit_id"))


@query("b21_select_existing", "SELECT o_totalprice, o_orderkey FROM orders")
def _(t):
    return select_existing(t.orders, ["o_totalprice", "not_there", "o_orderkey", "o_totalprice"])


@query("b22_rename_map", """
    SELECT o_orderkey AS household_id, o_custkey, o_orderstatus AS area, o_totalprice AS income FROM orders""")
def _(t):
    picked = select_existing(t.orders, ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"])
    return rename_map(picked, {"o_orderkey": "household_id", "o_orderstatus": "area", "o_totalprice": "income",
                               "absent": "nothing"})[0]


@query("b22b_rename_report", """
    WITH n AS (SELECT COUNT(*) AS n_rows FROM orders)
    SELECT * FROM (VALUES ('o_orderkey', 'household_id', true), ('o_custkey', 'o_custkey', false))
      AS v(original_column, renamed_column, was_renamed), n""")
def _(t):
    from ..operators.common import attach_scalars

    renamed, report = rename_map(t.orders.select("o_orderkey", "o_custkey"), {"o_orderkey": "household_id"})
    return attach_scalars(report, renamed.agg(F.count(F.lit(1)).alias("n_rows")))


@query("b23_storage_safe", """
    SELECT event_id, event_type, '{"k":' || json_extract_string(props, '$.k') || '}' AS props FROM events""")
def _(t):
    parsed = t.events.select("event_id", "event_type", F.from_json("props", "k int").alias("props"))
    return storage_safe(parsed)


@query("b25_engineered_features", """
    SELECT o_orderkey, round(n_lines / nullif(qty_min, 0), 6) AS lines_per_quantity,
           round((n_a + n_r) / nullif(n_lines, 0), 6) AS share_returned,
           round(coalesce(disc, 0) + coalesce(tax, 0), 6) AS transfers_total
    FROM (SELECT o_orderkey, COUNT(l_orderkey) AS n_lines, MIN(l_quantity) AS qty_min,
                 COUNT(*) FILTER (l_returnflag = 'A') AS n_a, COUNT(*) FILTER (l_returnflag = 'R') AS n_r,
                 SUM(l_discount) AS disc, SUM(l_tax) AS tax
          FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey)""")
def _(t):
    li = t.lineitem.groupBy(col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.min("l_quantity").alias("qty_min"),
        F.count_if(col("l_returnflag") == "A").alias("n_a"), F.count_if(col("l_returnflag") == "R").alias("n_r"),
        F.sum("l_discount").alias("disc"), F.sum("l_tax").alias("tax"))
    joined = t.orders.select("o_orderkey").join(li, "o_orderkey", "left").na.fill(0, ["n_lines", "n_a", "n_r"])
    spec = [Indicator("lines_per_quantity", ("n_lines", "qty_min"), ratio),
            Indicator("_returned", ("n_a", "n_r", "not_there"), row_sum, partial=True),
            Indicator("share_returned", ("_returned", "n_lines"), ratio),
            Indicator("transfers_total", ("disc", "tax"), lambda *c: row_sum(c)),
            Indicator("skipped", ("absent",), lambda c: c)]
    out = derive_indicators(joined, spec)
    return out.select("o_orderkey", *[F.round(c, 6).alias(c) for c in ("lines_per_quantity", "share_returned",
                                                                      "transfers_total")])


@query("b26_programme_totals", """
    SELECT l_orderkey, l_linenumber, round(l_discount + l_tax, 6) AS food_amount,
           CAST(l_discount + l_tax > 0 AS INTEGER) AS gets_food, round(l_tax, 6) AS other_amount,
           CAST(l_tax > 0 AS INTEGER) AS gets_other FROM lineitem""")
def _(t):
    out = programme_totals(t.lineitem, {"food_amount": ("gets_food", ["l_discount", "l_tax"]),
                                        "other_amount": ("gets_other", ["l_tax", "absent"])})
    return out.select("l_orderkey", "l_linenumber", F.round("food_amount", 6).alias("food_amount"), "gets_food",
                      F.round("other_amount", 6).alias("other_amount"), "gets_other")


@query("b27_derived_indicators", """
    SELECT o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS code,
           substr(lpad(CAST(o_custkey AS VARCHAR), 6, '0'), 1, 4) AS province,
           CASE lower(o_orderstatus) WHEN 'f' THEN 1 WHEN 'o' THEN 0 END AS sex_bin,
           lower(o_orderpriority) AS material,
           CAST(lower(o_orderpriority) IN ('1-urgent', '2-high') AS INTEGER) AS precarious,
           CAST(contains(lower(o_orderpriority), 'specified') AS INTEGER) AS network,
           CAST(lower(o_orderpriority) IN ('1-urgent', '2-high') AND o_totalprice > 200000 AS INTEGER) AS safe_proxy,
           CASE WHEN contains(lower(o_orderpriority), 'low') THEN 'rural' ELSE 'urban' END AS area,
           CAST(contains(lower(o_orderpriority), 'low') AS INTEGER) AS area_bin,
           round(o_totalprice / nullif(o_custkey % 4, 0), 4) AS income_pc FROM orders""")
def _(t):
    from ..functions import flag

    spec = [Indicator("code", ("o_custkey",), lambda c: zfill(c, 6)),
            Indicator("province", ("code",), lambda c: code_levels(c, [4])[0]),
            Indicator("sex_bin", ("o_orderstatus",), lambda c: map_values(norm_cat(c), {"f": 1, "o": 0})),
            Indicator("material", ("o_orderpriority",), norm_cat),
            Indicator("precarious", ("material",), lambda c: flag_in(c, ["1-urgent", "2-high"])),
            Indicator("network", ("material",), lambda c: flag_contains(c, "specified")),
            Indicator("rich", ("o_totalprice",), lambda c: flag(as_number(c) > 200000)),
            Indicator("safe_proxy", ("precarious", "rich"), lambda a, b: flag_all([a, b])),
            Indicator("area", ("material",), lambda c: if_else(c.contains("low"), "rural", "urban")),
            Indicator("area_bin", ("area",), lambda c: flag_eq(c, "rural")),
            Indicator("income_pc", ("o_totalprice", "o_custkey"), lambda a, b: F.round(ratio(a, b % 4), 4))]
    return derive_indicators(t.orders, spec).select(
        "o_orderkey", "code", "province", "sex_bin", "material", "precarious", "network", "safe_proxy", "area",
        "area_bin", "income_pc")


# ---------------------------------------------------------------- one operator each

@query("b09_flag_in", """
    SELECT c_custkey, CAST(coalesce(nullif(c_mktsegment, 'BUILDING') IN ('MACHINERY', 'HOUSEHOLD'), false) AS INTEGER) AS f
    FROM customer""")
def _(t):
    return t.customer.select("c_custkey", flag_in(F.nullif("c_mktsegment", F.lit("BUILDING")), ["MACHINERY", "HOUSEHOLD"]).alias("f"))


@query("b10_flag_contains", "SELECT doc_id, CAST(contains(text, 'tion') AS INTEGER) AS f FROM documents")
def _(t):
    return t.documents.select("doc_id", flag_contains("text", "tion").alias("f"))


@query("b12_flag_all", """
    SELECT p_partkey, CAST(p_size > 25 AND p_type = 'PROMO' AS INTEGER) AS proxy FROM part""")
def _(t):
    from ..functions import flag

    parts = t.part.select("p_partkey", flag(col("p_size") > 25).alias("big"), flag_eq("p_type", "PROMO").alias("promo"))
    return parts.select("p_partkey", flag_all(["big", "promo"]).alias("proxy"))


@query("b13_if_else", """
    SELECT c_custkey, CASE WHEN contains(nullif(c_mktsegment, 'MACHINERY'), 'E') THEN 'rural' ELSE 'urbana' END AS area
    FROM customer""")
def _(t):
    seg = F.nullif("c_mktsegment", F.lit("MACHINERY"))
    return t.customer.select("c_custkey", if_else(seg.contains("E"), "rural", "urbana").alias("area"))


@query("b14_flag_reported", """
    SELECT event_id, CAST(coalesce(lower(trim(nullif(event_type, 'error'))) <> 'click', false) AS INTEGER) AS reported FROM events""")
def _(t):
    return t.events.select("event_id", flag_reported(F.nullif("event_type", F.lit("error")), ["click"]).alias("reported"))


@query("b15_any_reported", """
    SELECT doc_id, CAST(coalesce(lower(trim(nullif(lang, 'de'))) NOT IN ('en', 'none', ''), false)
        OR coalesce(nullif(source, 'src1') NOT IN ('src2', 'en'), false) AS INTEGER) AS any_answer FROM documents""")
def _(t):
    docs = t.documents.select("doc_id", F.nullif("lang", F.lit("de")).alias("a"), F.nullif("source", F.lit("src1")).alias("b"))
    return docs.select("doc_id", any_reported(["a", "b"], ["en", "none", "", "src2"]).alias("any_answer"))


@query("b16_count_positive", """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_discount > 0 AS INTEGER) + CAST(l_tax > 0 AS INTEGER) AS n_positive FROM lineitem""")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", count_positive(["l_discount", "l_tax"]).alias("n_positive"))


@query("b17_ratio", """
    SELECT p_partkey, round(p_retailprice / nullif(p_size % 5, 0), 6) AS price_ratio FROM part""")
def _(t):
    return t.part.select("p_partkey", F.round(ratio("p_retailprice", col("p_size") % 5), 6).alias("price_ratio"))


@query("b18_row_sum", """
    SELECT o_orderkey, round(coalesce(TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE), 0)
        + coalesce(TRY_CAST(o_orderstatus AS DOUBLE), 0) + o_totalprice, 4) AS total FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", F.round(row_sum(
        [F.substring("o_orderpriority", 1, 1), "o_orderstatus", "o_totalprice"]), 4).alias("total"))


@query("b19_fill_int", """
    SELECT c_custkey, CAST(coalesce(nullif(c_nationkey, 3), 99) AS INTEGER) AS nation FROM customer""")
def _(t):
    df = t.customer.select("c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("nation"))
    return fill_int(df, ["nation", "absent"], 99)


# ---------------------------------------------------------------- filters

C6 = "lpad(CAST(o_custkey AS VARCHAR), 6, '0')"


@query("c01_filter_prefix", f"SELECT o_orderkey, {C6} AS code FROM orders WHERE {C6} LIKE '0001%'")
def _(t):
    df = t.orders.select("o_orderkey", col("o_custkey").cast("string").alias("code"))
    return filter_prefix(df, "code", "0001")[0]


@query("c01b_filter_prefix_audit", f"""
    SELECT 'orders' AS table_name, true AS has_code, COUNT(*) AS before_rows,
           COUNT(*) FILTER ({C6} LIKE '0001%') AS after_rows,
           list_sort(list_distinct(list(CASE WHEN {C6} LIKE '0001%' THEN substr({C6}, 1, 4) END))) AS codes_left
    FROM orders""")
def _(t):
    df = t.orders.select("o_orderkey", col("o_custkey").cast("string").alias("code"))
    return filter_prefix(df, "code", "0001", "orders")[1]


def _region_audit_sql(table, key):
    kept = f"lpad(CAST({key} AS VARCHAR), 6, '0') LIKE '00010%'"
    return f"""SELECT '{table}' AS table_name, true AS has_code, COUNT(*) AS before_rows, COUNT(*) FILTER ({kept}) AS after_rows,
        CASE WHEN COUNT(*) FILTER ({kept}) > 0 THEN '00010' ELSE '' END AS codes_left, COUNT(*) FILTER ({kept}) > 0 AS all_match FROM {table}"""


@query("c02_filter_all", f"""
    {_region_audit_sql("orders", "o_custkey")} UNION ALL {_region_audit_sql("customer", "c_custkey")}
    UNION ALL SELECT 'part', false, COUNT(*), COUNT(*), '', true FROM part""")
def _(t):
    tables = {"orders": t.orders.withColumn("code", col("o_custkey").cast("string")),
              "customer": t.customer.withColumn("code", col("c_custkey").cast("string")), "part": t.part}
    return filter_all(tables, "code", "00010")[1].withColumn("codes_left", F.array_join("codes_left", ","))


TARGET = "CASE WHEN o_orderstatus = 'F' THEN '1' WHEN o_orderstatus = 'O' THEN '0' WHEN o_orderkey % 2 = 0 THEN 'x' END"


def _with_target(t):
    value = F.when(col("o_orderstatus") == "F", "1").when(col("o_orderstatus") == "O", "0").when(
        col("o_orderkey") % 2 == 0, "x")
    return t.orders.select("o_orderkey", value.alias("target"))


@query("c04_drop_null_target", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS target FROM orders
    WHERE o_orderstatus IN ('F', 'O')""")
def _(t):
    return drop_null_target(_with_target(t), "target")[0]


@query("c04b_drop_null_target_audit", f"""
    SELECT COUNT(*) AS rows_before, COUNT(*) FILTER (y IS NULL) AS null_targets,
           COUNT(*) FILTER (y = 'x') AS unreadable_targets, COUNT(*) FILTER (y IN ('0', '1')) AS rows_after
    FROM (SELECT {TARGET} AS y FROM orders)""")
def _(t):
    return drop_null_target(_with_target(t), "target")[1]


@query("c05_between", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity BETWEEN 6 AND 16")
def _(t):
    return t.lineitem.filter(between("l_quantity", 6, 16)).select("l_orderkey", "l_linenumber", "l_quantity")


@query("c06_semi_keep", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN
      (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def _(t):
    keys = t.customer.filter(col("c_mktsegment") == "BUILDING").select(col("c_custkey").alias("o_custkey"))
    return semi_keep(t.orders.select("o_orderkey", "o_custkey"), keys, ["o_custkey"])


@query("c07_metric_floor", """
    SELECT * FROM (SELECT o_custkey, round(avg(CAST(o_orderstatus = 'F' AS INTEGER)), 6) AS precision
                   FROM orders GROUP BY o_custkey) WHERE precision >= 0.25""")
def _(t):
    rates = t.orders.groupBy("o_custkey").agg(
        F.round(F.avg((col("o_orderstatus") == "F").cast("int")), 6).alias("precision"))
    return metric_floor(rates, "precision", 0.25)
