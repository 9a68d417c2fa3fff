"""Key audits, table rules and dictionaries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.functions import col

from .. import plans
from ..operators import quality as Q
from ..operators.common import attach_scalars
from ..operators.profile import profile_columns
from .aggregates import LINE_COLS, LINES, _profile_sql, lines
from .registry import query


@query("e21_key_audit", """
    SELECT 'lineitem' AS table_name, k AS candidate_key, d AS duplicate_count, d = 0 AS is_unique FROM (
      SELECT 'l_orderkey|l_linenumber' AS k, COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS d FROM lineitem
      UNION ALL SELECT 'l_orderkey', COUNT(*) - COUNT(DISTINCT l_orderkey) FROM lineitem
      UNION ALL SELECT 'l_orderkey|l_linenumber|l_partkey|l_suppkey',
        COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_suppkey)) FROM lineitem)""")
def _(t):
    return Q.key_audit(t.lineitem, [["l_orderkey", "l_linenumber"], ["l_orderkey"], ["absent"],
                                    ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]], "lineitem")


@query("e22_duplicate_groups", """
    SELECT l_orderkey, l_linenumber, COUNT(*) AS duplicate_rows FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1
    ORDER BY duplicate_rows DESC, l_orderkey, l_linenumber LIMIT 20""")
def _(t):
    return Q.duplicate_groups(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("e23_duplicate_rows", """
    SELECT (SELECT COUNT(*) FROM lineitem) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM lineitem)) AS duplicate_rows""")
def _(t):
    return Q.duplicate_rows(t.lineitem)


@query("e23b_duplicate_rows_present", """
    SELECT COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber % 2, l_returnflag FROM lineitem))
           AS duplicate_rows FROM lineitem""")
def _(t):
    return Q.duplicate_rows(t.lineitem.select("l_orderkey", (col("l_linenumber") % 2).alias("odd"), "l_returnflag"))


@query("j01_key_violations", """
    SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1""")
def _(t):
    Q.assert_unique(t.orders, ["o_orderkey"], "orders")
    return Q.key_violations(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("j02_rule_violations", f"""
    SELECT 'lines_lt_returned' AS rule, COUNT(*) FILTER (n_lines < n_returned * 2) AS violations FROM {LINES}
    UNION ALL SELECT 'age_outside', COUNT(*) FILTER (first_ship < 12 OR first_ship > 40) FROM {LINES}
    UNION ALL SELECT 'count_mismatch', COUNT(*) FILTER (n_lines <> first_ship) FROM {LINES}""")
def _(t):
    return Q.rule_violations(lines(t), {
        "lines_lt_returned": col("n_lines") < col("n_returned") * 2,
        "age_outside": (col("first_ship") < 12) | (col("first_ship") > 40),
        "count_mismatch": col("n_lines") != col("first_ship")})


BINARY = """(SELECT CAST(l_returnflag = 'R' AS INTEGER) AS flag, CAST(l_returnflag = 'R' AS DECIMAL(9,2)) AS price_flag,
    l_linenumber, l_partkey FROM lineitem)"""


@query("j03_binary_validation", " UNION ALL ".join(f"""
    SELECT DISTINCT '{c}' AS variable, CAST({c} AS VARCHAR) AS value, (SELECT COUNT(DISTINCT {c}) FROM {BINARY}) AS n_values,
           {yes} AS is_binary_01 FROM {BINARY}""" for c, yes in (
    ("flag", "true"), ("price_flag", "true"), ("l_linenumber", "false"), ("l_partkey", "false"))))
def _(t):
    flag = (col("l_returnflag") == "R").cast("int")
    li = t.lineitem.select(flag.alias("flag"), flag.cast("decimal(9,2)").alias("price_flag"), "l_linenumber", "l_partkey")
    return Q.binary_validation(li, ["flag", "price_flag", "l_linenumber", "l_partkey"])


@query("j04_drop_constant", """
    SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN 1 END AS half_null FROM orders""")
def _(t):
    df = t.orders.select("o_orderkey", "o_totalprice", F.lit("x").alias("fixed"), F.lit(None).cast("double").alias("empty"),
                         F.when(col("o_orderkey") % 2 == 0, 1).alias("half_null"))
    return Q.drop_constant(df)[0]


@query("j04b_constant_report", """
    SELECT * FROM (VALUES ('fixed', 'constant'), ('empty', 'all_null')) AS v(variable, reason),
      (SELECT COUNT(*) AS n_rows FROM orders)""")
def _(t):
    df = t.orders.select("o_orderkey", F.lit("x").alias("fixed"), F.lit(None).cast("double").alias("empty"))
    left, report = Q.drop_constant(df)
    return attach_scalars(report, left.agg(F.count(F.lit(1)).alias("n_rows")))


RULES = Q.DropRules(leakage={"o_totalprice": "close to the official rule", "absent": "not in the table"},
                    redundant={"copy": "same as o_custkey"}, identifiers=["o_orderkey"], auxiliary=["o_orderdate"])


@query("j05_apply_drop_rules", "SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders")
def _(t):
    df = t.orders.withColumns({"copy": col("o_custkey"), "fixed": F.lit(1)})
    return Q.apply_drop_rules(df, RULES)[0]


@query("j05b_drop_reasons", """
    SELECT * FROM (VALUES ('o_totalprice', 'leakage', 'close to the official rule'), ('copy', 'redundant', 'same as o_custkey'),
      ('o_orderkey', 'identifier', 'identifier without use in a model'),
      ('o_orderdate', 'auxiliary', 'auxiliary or control column'), ('fixed', 'constant', 'constant'))
      AS v(variable, kind, reason), (SELECT COUNT(*) AS n_rows FROM orders)""")
def _(t):
    df = t.orders.withColumns({"copy": col("o_custkey"), "fixed": F.lit(1)})
    left, reasons = Q.apply_drop_rules(df, RULES)
    return attach_scalars(reasons, left.agg(F.count(F.lit(1)).alias("n_rows")))


@query("j06_recommend_features", f"""
    SELECT variable, CASE WHEN variable = 'n_returned' THEN 'target' WHEN variable LIKE '%price%' OR variable LIKE '%ship%'
      THEN 'exclude_conservative' WHEN null_pct > 30 THEN 'review' WHEN n_unique <= 1 THEN 'exclude'
      ELSE 'include_conservative' END AS decision, CASE WHEN variable = 'n_returned' THEN 'target variable'
      WHEN variable LIKE '%price%' OR variable LIKE '%ship%' THEN 'name suggests leakage'
      WHEN null_pct > 30 THEN 'high share of missing values' WHEN n_unique <= 1 THEN 'constant column'
      ELSE 'usable in exploration and first models' END AS reason FROM (
        SELECT variable, null_pct, n_unique FROM ({_profile_sql(LINES, LINE_COLS)})
        UNION ALL SELECT 'fixed', 0, 1 UNION ALL SELECT 'sparse', 60, 2)""")
def _(t):
    df = lines(t).withColumns({"fixed": F.lit(2), "sparse": F.when(col("o_orderkey") % 5 < 2, col("o_orderkey") % 2)})
    return Q.recommend_features(profile_columns(df), ["price", "ship"], "n_returned")


def _typed(c, kind, dtype, encode):
    return f"""SELECT '{c}' AS variable, '{kind}' AS feature_type, '{dtype}' AS dtype,
        round((COUNT(*) - COUNT({c})) * 100.0 / COUNT(*), 4) AS null_pct, COUNT({c}) < COUNT(*) AS needs_imputation,
        {encode} AS needs_encoding FROM (SELECT *, CASE WHEN n_lines > 3 THEN 1 WHEN n_lines > 0 THEN 0 END AS many FROM {LINES})"""


@query("j07_classify_features", " UNION ALL ".join([
    _typed("o_orderkey", "numeric", "bigint", "false"), _typed("o_orderpriority", "categorical", "string", "true"),
    _typed("n_lines", "numeric", "bigint", "false"), _typed("n_returned", "numeric", "bigint", "false"),
    _typed("first_ship", "numeric", "double", "false"), _typed("many", "binary", "int", "false")]))
def _(t):
    df = lines(t).withColumn("many", F.when(col("n_lines") > 3, 1).when(col("n_lines") > 0, 0))
    return Q.classify_features(df)


@query("j08_classify_tables", """
    SELECT source AS table_name, COUNT(*) AS columns,
      CASE WHEN bool_or(lang = 'fr') AND bool_or(lang = 'es') AND bool_or(lang = 'de') THEN 'person'
           WHEN bool_or(lang = 'fr') AND bool_or(lang = 'en') THEN 'household' ELSE 'unknown' END AS grain,
      CASE WHEN bool_or(lang = 'fr') AND bool_or(lang = 'es') AND bool_or(lang = 'de') THEN 'aggregate'
           WHEN bool_or(lang = 'fr') AND bool_or(lang = 'en') THEN 'direct' ELSE 'review' END AS merge_strategy
    FROM (SELECT source || '-' || (doc_id % 7) AS source, lang FROM documents) GROUP BY source""")
def _(t):
    schema = t.documents.select(F.concat_ws("-", "source", col("doc_id") % 7).alias("table_name"),
                                col("lang").alias("column_name"))
    return Q.classify_tables(schema, [(["fr", "es", "de"], "person", "aggregate"), (["fr", "en"], "household", "direct")],
                             ("unknown", "review"))


DIMS = [Q.DimensionRule("weight", "expansion", names=["Brand#1/PROMO"], eligible=False, family="none", reason="a weight"),
        Q.DimensionRule("services", "water", names=["Brand#2/SMALL", "Brand#2/LARGE"], eligible_except=["Brand#2/LARGE"],
                        family="basic", reason="large repeats small"),
        Q.DimensionRule("energy", "fuel", prefixes=["Brand#2"], names=["Brand#3/PROMO"],
                        eligible_only=["Brand#3/PROMO", "Brand#22/PROMO"], family="energy",
                        reason="promotions carry it"),
        Q.DimensionRule("money", "income", prefixes=["Brand#1", "Brand#4"], eligible=False, reason="an amount")]
DIM_SQL = """SELECT p_partkey, v AS variable,
    CASE WHEN v = 'Brand#1/PROMO' THEN 'weight' WHEN v IN ('Brand#2/SMALL', 'Brand#2/LARGE') THEN 'services'
      WHEN v LIKE 'Brand#2%' OR v = 'Brand#3/PROMO' THEN 'energy' WHEN v LIKE 'Brand#1%' OR v LIKE 'Brand#4%' THEN 'money'
      ELSE 'manual' END AS dimension,
    CASE WHEN v = 'Brand#1/PROMO' THEN 'none' WHEN v IN ('Brand#2/SMALL', 'Brand#2/LARGE') THEN 'basic'
      WHEN v LIKE 'Brand#2%' OR v = 'Brand#3/PROMO' THEN 'energy' ELSE 'none' END AS family,
    CASE WHEN v = 'Brand#1/PROMO' THEN false WHEN v = 'Brand#2/SMALL' THEN true WHEN v = 'Brand#2/LARGE' THEN false
      WHEN v LIKE 'Brand#2%' OR v = 'Brand#3/PROMO' THEN v IN ('Brand#3/PROMO', 'Brand#22/PROMO') ELSE false END AS eligible,
    CASE WHEN v = 'Brand#1/PROMO' THEN 'expansion' WHEN v IN ('Brand#2/SMALL', 'Brand#2/LARGE') THEN 'water'
      WHEN v LIKE 'Brand#2%' OR v = 'Brand#3/PROMO' THEN 'fuel' WHEN v LIKE 'Brand#1%' OR v LIKE 'Brand#4%' THEN 'income'
      ELSE 'pending' END AS subdimension,
    CASE WHEN v = 'Brand#1/PROMO' THEN 'a weight' WHEN v IN ('Brand#2/SMALL', 'Brand#2/LARGE') THEN 'large repeats small'
      WHEN v LIKE 'Brand#2%' OR v = 'Brand#3/PROMO' THEN 'promotions carry it'
      WHEN v LIKE 'Brand#1%' OR v LIKE 'Brand#4%' THEN 'an amount' ELSE 'look at it first' END AS reason
    FROM (SELECT p_partkey, p_brand || '/' || p_type AS v FROM part)"""


def _classified(t):
    variables = t.part.select("p_partkey", F.concat_ws("/", "p_brand", "p_type").alias("variable"))
    return Q.classify_variables(variables, DIMS, Q.DimensionRule("manual", "pending", eligible=False, reason="look at it first"))


@query("j09_classify_variables", DIM_SQL)
def _(t):
    return _classified(t)


@query("j09b_dimension_summary", f"SELECT dimension, family, eligible, COUNT(*) AS n_variables FROM ({DIM_SQL}) GROUP BY ALL")
def _(t):
    return Q.dimension_summary(_classified(t))


@query("j10_build_dictionary", f"""
    SELECT variable, dtype, null_pct,
      CASE variable WHEN 'n_lines' THEN 'short 1' WHEN 'first_ship' THEN 'long 2' ELSE variable END AS description,
      CASE variable WHEN 'n_lines' THEN 'roster' ELSE 'unknown' END AS module,
      CASE variable WHEN 'o_orderkey' THEN 'identifier' ELSE 'feature' END AS role,
      CASE variable WHEN 'first_ship' THEN 'check first' ELSE '' END AS note
    FROM ({_profile_sql(LINES, LINE_COLS)})""")
def _(t):
    spark = t._spark
    short = spark.createDataFrame([("n_lines", "short 1", "roster")], "name string, text string, module string")
    long = spark.createDataFrame([("first_ship", "long 2"), ("n_lines", "long 1")], "name string, label string")
    return Q.build_dictionary(
        lines(t), {"description": ([(short, "name", "text", "variable"), (long, "name", "label", "variable")], col("variable")),
                   "module": ([(short, "name", "module", "variable")], F.lit("unknown"))},
        {"o_orderkey": "identifier"}, notes={"first_ship": "check first"})


@query("j11_redundancy_matrix", """
    WITH s AS (SELECT 'S' || c_custkey AS variable, c_acctbal AS f_score, c_acctbal / 10000 AS p_value FROM customer)
    SELECT 'S' || c_custkey AS "drop", 'S' || (c_custkey + 1000) AS keep, c_mktsegment AS kind,
           d.f_score AS f_score_drop, k.f_score AS f_score_keep, d.p_value AS p_value_drop, k.p_value AS p_value_keep
    FROM customer LEFT JOIN s d ON d.variable = 'S' || c_custkey LEFT JOIN s k ON k.variable = 'S' || (c_custkey + 1000)""")
def _(t):
    name = F.concat(F.lit("S"), col("c_custkey"))
    rules = t.customer.select(name.alias("drop"), F.concat(F.lit("S"), col("c_custkey") + 1000).alias("keep"),
                              col("c_mktsegment").alias("kind"))
    scores = t.customer.select(name.alias("variable"), col("c_acctbal").alias("f_score"),
                               (col("c_acctbal") / 10000).alias("p_value"))
    return Q.redundancy_matrix(rules, scores)


@query("j11b_redundancy_matrix_scores_listed_twice", """
    WITH s AS (SELECT 'S' || c_custkey AS variable, c_acctbal AS f_score, c_acctbal / 10000 AS p_value FROM customer)
    SELECT 'S' || c_custkey AS "drop", 'S' || (c_custkey + 1000) AS keep, c_mktsegment AS kind,
           d.f_score AS f_score_drop, k.f_score AS f_score_keep, d.p_value AS p_value_drop, k.p_value AS p_value_keep
    FROM customer LEFT JOIN s d ON d.variable = 'S' || c_custkey LEFT JOIN s k ON k.variable = 'S' || (c_custkey + 1000)""")
def _(t):
    name = F.concat(F.lit("S"), col("c_custkey"))
    rules = t.customer.select(name.alias("drop"), F.concat(F.lit("S"), col("c_custkey") + 1000).alias("keep"),
                              col("c_mktsegment").alias("kind"))
    scores = t.customer.select(name.alias("variable"), col("c_acctbal").alias("f_score"),
                               (col("c_acctbal") / 10000).alias("p_value"))
    lower = scores.withColumn("f_score", col("f_score") - 1)
    return Q.redundancy_matrix(rules, lower.unionByName(scores))


CONCEPTS = {"speed": ["ouch", "tion"], "home": ["casa", "haus"], "nothing": ["zzqqy", "qqzzx"]}


def _concept_sql():
    rows = [(c, q) for c, qs in CONCEPTS.items() for q in qs]
    hits = " UNION ALL ".join(f"""SELECT '{c}' AS concept, '{q}' AS query,
        COUNT(*) FILTER (contains(lower(text), '{q}')) AS raw,
        COUNT(*) FILTER (contains(lower(text), '{q}') AND lang IN ('en', 'es')) AS kept FROM documents""" for c, q in rows)
    joined = "CASE concept " + " ".join(f"WHEN '{c}' THEN '{'|'.join(qs)}'" for c, qs in CONCEPTS.items()) + " END"
    return f"""WITH h AS ({hits}) SELECT concept, query, raw AS result_count_raw, kept AS result_count_filtered,
        CASE WHEN kept > 0 THEN 'ok' WHEN raw > 0 THEN 'outside_universe' ELSE 'no_results' END AS status FROM h
        UNION ALL SELECT concept, {joined}, 0, 0, 'no_direct_equivalent' FROM h GROUP BY concept HAVING SUM(kept) = 0"""


@query("j12_concept_search", _concept_sql())
def _(t):
    return Q.concept_search(t.documents, "text", CONCEPTS, col("lang").isin("en", "es"))


@query("j13_validate", """
    SELECT 'step 4' AS step, COUNT(*) > 0 AND COUNT(*) FILTER (o_custkey < 0) = 0 AS passed, COUNT(*) AS n_rows,
           COUNT(*) FILTER (o_custkey < 0) AS bad_codes FROM orders""")
def _(t):
    return Q.validate(t.orders, "step 4", {"n_rows": F.count(F.lit(1)), "bad_codes": F.count_if(col("o_custkey") < 0)},
                      (col("n_rows") > 0) & (col("bad_codes") == 0))


def _model_ready(t):
    return Q.model_ready(t.orders, ["o_orderkey"], ["o_custkey", "o_orderkey"], "household_id",
                         ["o_totalprice", "o_orderstatus", "absent"], ["o_orderpriority"],
                         {"o_orderkey": "conglome", "o_totalprice": "weight", "o_orderstatus": "target",
                          "o_orderpriority": "priority_cat", "absent": "gone"})


@query("j14_model_ready", """
    SELECT o_custkey || '_' || o_orderkey AS household_id, o_orderkey AS conglome, o_custkey, o_totalprice AS weight,
           o_orderstatus AS target, o_orderpriority AS priority_cat FROM orders""")
def _(t):
    return _model_ready(t)[0]


@query("j14b_model_ready_names", """
    SELECT v.*, n.n_present FROM (VALUES ('household_id', 'household_id', false), ('o_custkey', 'o_custkey', false),
        ('o_orderkey', 'conglome', true), ('o_totalprice', 'weight', true), ('o_orderstatus', 'target', true),
        ('o_orderpriority', 'priority_cat', true)) AS v(original_column, renamed_column, was_renamed) JOIN (
      UNPIVOT (SELECT COUNT(o_custkey || o_orderkey) AS household_id, COUNT(o_custkey) AS o_custkey, COUNT(o_orderkey) AS o_orderkey,
        COUNT(o_totalprice) AS o_totalprice, COUNT(o_orderstatus) AS o_orderstatus, COUNT(o_orderpriority) AS o_orderpriority FROM orders)
      ON COLUMNS(*) INTO NAME original_column VALUE n_present) AS n USING (original_column)""")
def _(t):
    """The rename report, with the values present in each column of the table it describes."""
    table, report = _model_ready(t)
    present = table.agg(*[F.count(c).alias(c) for c in table.columns]).unpivot([], table.columns, "renamed_column", "n_present")
    return report.join(present, "renamed_column")


@query("j15_variable_dictionary", f"""
    SELECT 'n_lines' AS variable, 'lines per order' AS description, 'count' AS rule,
           round((COUNT(*) - COUNT(n_lines)) * 100.0 / COUNT(*), 4) AS null_pct FROM {LINES}
    UNION ALL SELECT 'first_ship', 'smallest quantity', 'min', round((COUNT(*) - COUNT(first_ship)) * 100.0 / COUNT(*), 4)
      FROM {LINES}""")
def _(t):
    spec = t._spark.createDataFrame([("n_lines", "lines per order", "count"), ("first_ship", "smallest quantity", "min"),
                                     ("absent", "none", "none")], "variable string, description string, rule string")
    return Q.variable_dictionary(lines(t), spec)


@query("j16_variable_map", """
    SELECT 'P' || p_partkey AS variable_original,
           CASE WHEN p_partkey = 7 THEN 'weight_final' ELSE 'P' || p_partkey END AS variable_final,
           CASE WHEN p_partkey IN (1, 2) THEN 'identifier' WHEN p_partkey = 7 THEN 'weight' ELSE 'feature' END AS role,
           CASE WHEN p_partkey IN (1, 2) THEN 'tracing' WHEN p_partkey = 7 THEN 'weighting' ELSE 'metadata' END AS "group",
           p_partkey NOT IN (1, 2, 7) AS in_training, '' AS description FROM part
    UNION ALL SELECT 'P' || p_partkey, CASE WHEN p_partkey = 7 THEN 'weight_final' ELSE 'P' || p_partkey END,
           'feature', p_brand, true, p_name FROM part WHERE p_partkey IN (2, 7)""")
def _(t):
    name = F.concat(F.lit("P"), col("p_partkey"))
    features = t.part.filter("p_partkey = 7 OR p_partkey = 2 OR p_partkey > 10").select(
        name.alias("variable"), col("p_brand").alias("group"), col("p_name").alias("description"))
    return Q.variable_map(t.part.select(name.alias("variable")),
                          [(["P1", "P2"], "identifier", "tracing", False), (["P7"], "weight", "weighting", False)],
                          {"P7": "weight_final"}, features)


ROLES = {"o_orderkey": "numeric", "o_custkey": "numeric", "o_orderstatus": "categorical", "half": "binary", "urgent": "target", "empty": "binary"}


def _explored(t, report):
    df = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", (col("o_orderkey") % 2).cast("int").alias("half"),
                         (col("o_orderpriority") == "1-URGENT").cast("int").alias("urgent"), F.lit(None).cast("int").alias("empty"))
    return plans.explore(df, "urgent", leak_patterns=["cust"], reports=[report])[report]


@query("j17_explore_column_roles", " UNION ALL ".join(f"""
    SELECT '{c}' AS variable, '{r}' AS role, COUNT(*) - COUNT({c}) AS null_count, COUNT(DISTINCT {c}) AS n_unique FROM (SELECT *,
        o_orderkey % 2 AS half, CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS urgent, CAST(NULL AS INTEGER) AS empty FROM orders)""" for c, r in ROLES.items()))
def _(t):
    return _explored(t, "columns").select("variable", "role", "null_count", "n_unique")


@query("j17b_explore_recommendation", """SELECT * FROM (VALUES ('o_orderkey', 'include_conservative', 'usable in exploration and first models'),
    ('o_custkey', 'exclude_conservative', 'name suggests leakage'), ('o_orderstatus', 'include_conservative', 'usable in exploration and first models'),
    ('half', 'include_conservative', 'usable in exploration and first models'), ('urgent', 'target', 'target variable'),
    ('empty', 'review', 'high share of missing values')) AS v(variable, decision, reason), (SELECT 1 FROM orders LIMIT 1) AS one(x)""".replace("SELECT *", "SELECT variable, decision, reason", 1))
def _(t):
    return _explored(t, "recommendation")
