"""Roll-ups, profiles, distributions and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ..operators import profile as P
from ..operators import reshape as R
from ..operators import rollup as U
from ..operators.ordered import first_per_group
from .registry import query

ROUND = 6


def rounded(df, *cols, digits=ROUND):
    return df.withColumns({c: F.round(c, digits) for c in cols})


# ---------------------------------------------------------------- group aggregates

@query("e01_group_count", "SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n FROM orders GROUP BY ALL")
def _(t):
    return P.group_count(t.orders, ["o_orderstatus", "o_orderpriority"])


@query("e02_distinct_count_by", """
    SELECT l_returnflag, l_linestatus, COUNT(*) AS n_units FROM
      (SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem) GROUP BY ALL""")
def _(t):
    return P.distinct_count_by(t.lineitem, ["l_orderkey"], ["l_returnflag", "l_linestatus"])


@query("e03_nunique_by", "SELECT l_orderkey, COUNT(DISTINCT l_linenumber) AS n_members FROM lineitem GROUP BY l_orderkey")
def _(t):
    return P.nunique_by(t.lineitem, ["l_orderkey"], "l_linenumber", "n_members")


@query("e04_count_if_by_order", """
    SELECT l_orderkey, COUNT(*) FILTER (l_quantity BETWEEN 0 AND 5) AS n_0_5,
           COUNT(*) FILTER (l_quantity BETWEEN 6 AND 16) AS n_6_16, COUNT(*) FILTER (l_quantity >= 45) AS n_45_up
    FROM lineitem GROUP BY l_orderkey""")
def _(t):
    q = col("l_quantity")
    return U.count_if_by(t.lineitem, ["l_orderkey"], {"n_0_5": q.between(0, 5), "n_6_16": q.between(6, 16),
                                                      "n_45_up": q >= 45})


@query("e05_flag_agg_by", """
    SELECT l_orderkey, CAST(SUM(CAST(l_returnflag = 'R' AS INTEGER)) AS BIGINT) AS n_returned,
           MAX(CAST(l_linestatus = 'F' AS INTEGER)) AS max_final,
           CAST(SUM(CAST(l_returnflag = 'R' AS INTEGER)) > 0 AS INTEGER) AS any_returned
    FROM lineitem GROUP BY l_orderkey""")
def _(t):
    li = t.lineitem.select("l_orderkey", (col("l_returnflag") == "R").cast("int").alias("r"),
                           (col("l_linestatus") == "F").cast("int").alias("f"))
    return U.flag_agg_by(li, ["l_orderkey"], {"n_returned": "r"}, {"max_final": "f"}, {"any_returned": "n_returned"})


PERSON_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"
TIE = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def head(cond, cols, order=PERSON_ORDER):
    picks = ", ".join(f"{c} AS {n}" for n, c in cols.items())
    return f"""SELECT l_orderkey, {picks} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {order})
        AS i FROM ({cond})) WHERE i = 1"""


@query("e06_rollup_roster", f"""
    SELECT * FROM (SELECT l_orderkey, COUNT(DISTINCT l_linenumber) AS n_members,
        COUNT(*) FILTER (l_quantity BETWEEN 0 AND 5) AS n_0_5, COUNT(*) FILTER (l_quantity BETWEEN 6 AND 16) AS n_6_16,
        COUNT(*) FILTER (l_quantity BETWEEN 45 AND 200) AS n_45_up, COUNT(*) FILTER (l_returnflag = 'R') AS n_heads
      FROM lineitem GROUP BY l_orderkey)
    LEFT JOIN ({head("SELECT * FROM lineitem WHERE l_returnflag = 'R'",
                     {"head_age": "l_quantity", "head_status": "l_linestatus"})}) USING (l_orderkey)""")
def _(t):
    return U.rollup_roster(t.lineitem, ["l_orderkey"], "l_linenumber", "l_quantity", col("l_returnflag") == "R",
                           {"n_0_5": (0, 5), "n_6_16": (6, 16), "n_45_up": (45, 200)},
                           {"head_age": "l_quantity", "head_status": "l_linestatus"}, TIE)


ROSTER = f"""(SELECT l_orderkey, l_linenumber, l_quantity AS age, l_returnflag FROM (SELECT *, row_number() OVER
    (PARTITION BY l_orderkey, l_linenumber ORDER BY {PERSON_ORDER}) AS i FROM lineitem) WHERE i = 1)"""
HEADS = f"(SELECT l_orderkey, MIN(l_linenumber) AS l_linenumber FROM {ROSTER} WHERE l_returnflag = 'R' GROUP BY 1)"


def roster_and_heads(t):
    unit = ["l_orderkey", "l_linenumber"]
    roster = first_per_group(t.lineitem, unit, TIE, keep=["l_quantity", "l_returnflag"])
    heads = U.find_heads(roster, ["l_orderkey"], "l_linenumber", col("l_returnflag") == "R")
    return roster, heads


@query("e07_rollup_education", f"""
    WITH e AS (SELECT li.*, r.age, CAST(h.l_linenumber IS NOT NULL AS INTEGER) AS is_head
               FROM lineitem li LEFT JOIN {ROSTER} r USING (l_orderkey, l_linenumber)
               LEFT JOIN {HEADS} h USING (l_orderkey, l_linenumber))
    SELECT *, CAST(n_not_enrolled > 0 AS INTEGER) AS any_not_enrolled,
           CAST(n_not_attending > 0 AS INTEGER) AS any_not_attending FROM (
      SELECT l_orderkey, COUNT(DISTINCT l_linenumber) AS n_persons, COUNT(*) FILTER (age BETWEEN 6 AND 16) AS n_school_age,
        COUNT(*) FILTER (age BETWEEN 6 AND 16 AND l_linestatus = 'F') AS n_enrolled,
        COUNT(*) FILTER (age BETWEEN 6 AND 16 AND l_linestatus = 'O') AS n_not_enrolled,
        COUNT(*) FILTER (age BETWEEN 6 AND 16 AND l_tax > 0.05) AS n_not_attending
      FROM e GROUP BY l_orderkey)
    LEFT JOIN ({head("SELECT * FROM e WHERE is_head = 1", {"head_level": "l_partkey", "head_degree": "l_discount"})})
      USING (l_orderkey)""")
def _(t):
    roster, heads = roster_and_heads(t)
    edu = t.lineitem.drop("l_shipdate")
    return U.rollup_education(
        edu, roster.select("l_orderkey", "l_linenumber", col("l_quantity").alias("age")), heads, ["l_orderkey"],
        "l_linenumber", "age", (6, 16), col("l_linestatus") == "F", col("l_linestatus") == "O", col("l_tax") > 0.05,
        {"head_level": "l_partkey", "head_degree": "l_discount"}, TIE)


@query("e08_rollup_health", """
    SELECT *, CAST(n_symptom > 0 AS INTEGER) AS any_symptom, CAST(n_no_care > 0 AS INTEGER) AS any_no_care FROM (
      SELECT l_orderkey, COUNT(DISTINCT l_linenumber) AS n_persons,
        COUNT(*) FILTER (l_returnflag <> 'N') AS n_symptom,
        COUNT(*) FILTER (nullif(l_tax, 0) IS NOT NULL OR nullif(l_returnflag, 'A') NOT IN ('N')) AS n_no_care,
        COUNT(*) FILTER (l_linestatus = 'F') AS n_insured FROM lineitem GROUP BY l_orderkey)""")
def _(t):
    from ..functions import any_reported, flag_eq, flag_reported, norm_cat

    li = t.lineitem.withColumns({"t1": F.nullif("l_tax", F.lit(0.0)), "t2": F.nullif("l_returnflag", F.lit("A"))})
    return U.rollup_health(li, ["l_orderkey"], "l_linenumber", {
        "n_symptom": flag_reported("l_returnflag", ["n"]), "n_no_care": any_reported(["t1", "t2"], ["n", ""]),
        "n_insured": flag_eq(norm_cat("l_linestatus"), "f")},
        {"any_symptom": "n_symptom", "any_no_care": "n_no_care"})


@query("e09_rollup_employment", f"""
    WITH e AS (SELECT li.l_orderkey, li.l_linenumber, CAST(l_discount > 0.08 OR l_tax > 0.06 AS INTEGER) AS earns,
               h.l_linenumber IS NOT NULL AS is_head FROM lineitem li LEFT JOIN {HEADS} h USING (l_orderkey, l_linenumber))
    SELECT *, CAST(n_earners > 0 AS INTEGER) AS any_earner FROM (
      SELECT l_orderkey, COUNT(DISTINCT l_linenumber) AS n_persons, CAST(SUM(earns) AS BIGINT) AS n_earners,
             MAX(CAST(is_head AND earns = 1 AS INTEGER)) AS head_earns FROM e GROUP BY l_orderkey)""")
def _(t):
    _, heads = roster_and_heads(t)
    li = t.lineitem.select("l_orderkey", "l_linenumber",
                           F.when(col("l_discount") > 0.08, col("l_discount")).alias("pay_a"),
                           F.when(col("l_tax") > 0.06, col("l_tax")).alias("pay_b"))
    return U.rollup_employment(li, heads, ["l_orderkey"], "l_linenumber", ["pay_a", "pay_b", "absent"])


# ---------------------------------------------------------------- profiles

@query("e10_numeric_by_target", """
    WITH l AS (UNPIVOT (SELECT CAST(o_orderstatus = 'F' AS INTEGER) AS y, o_totalprice, CAST(o_custkey AS DOUBLE) AS o_custkey
               FROM orders) ON o_totalprice, o_custkey INTO NAME variable VALUE value)
    SELECT variable, y AS target, COUNT(value) AS count, round(avg(value), 4) AS mean,
           round(quantile_cont(value, 0.5), 4) AS median, round(stddev_samp(value), 4) AS std, min(value) AS min,
           max(value) AS max FROM l GROUP BY ALL""")
def _(t):
    df = t.orders.withColumn("y", (col("o_orderstatus") == "F").cast("int"))
    return rounded(P.numeric_by_target(df, ["o_totalprice", "o_custkey"], "y"), "mean", "median", "std", digits=4)


@query("e11_value_counts", """
    SELECT nullif(event_type, 'error') AS value, COUNT(*) AS n,
           round(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 4) AS pct FROM events GROUP BY 1""")
def _(t):
    return P.value_counts(t.events.withColumn("kind", F.nullif("event_type", F.lit("error"))), "kind")


LINES = """(SELECT o_orderkey, o_orderpriority, n_lines, n_returned, first_ship FROM orders LEFT JOIN (SELECT l_orderkey,
    COUNT(*) AS n_lines, COUNT(*) FILTER (l_returnflag = 'R') AS n_returned, MIN(l_quantity) AS first_ship
    FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey)"""


def lines(t):
    li = t.lineitem.groupBy(col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(col("l_returnflag") == "R").alias("n_returned"),
        F.min("l_quantity").alias("first_ship"))
    return t.orders.select("o_orderkey", "o_orderpriority").join(li, "o_orderkey", "left")


def _profile_sql(table, cols):
    return " UNION ALL ".join(f"""SELECT '{c}' AS variable, '{k}' AS dtype, COUNT(*) - COUNT({c}) AS null_count,
        round((COUNT(*) - COUNT({c})) * 100.0 / COUNT(*), 4) AS null_pct, COUNT(DISTINCT {c}) AS n_unique FROM {table}"""
                              for c, k in cols.items())


LINE_COLS = {"o_orderkey": "bigint", "o_orderpriority": "string", "n_lines": "bigint", "n_returned": "bigint",
             "first_ship": "double"}


@query("e12_profile_columns", _profile_sql(LINES, LINE_COLS))
def _(t):
    return P.profile_columns(lines(t))


@query("e12c_profile_of_no_rows", f"""
    SELECT variable, dtype, CAST(0 AS BIGINT) AS null_count, CAST(0 AS DOUBLE) AS null_pct, CAST(0 AS BIGINT) AS n_unique
    FROM ({_profile_sql(LINES, LINE_COLS)}), (SELECT COUNT(*) AS n FROM lineitem WHERE l_quantity < 0) WHERE n = 0""")
def _(t):
    return P.profile_columns(lines(t).filter("first_ship < 0"))


@query("e12b_top_missing", f"""
    SELECT * FROM ({_profile_sql(LINES, LINE_COLS)}) ORDER BY null_pct DESC, variable LIMIT 2""")
def _(t):
    return P.top_missing(P.profile_columns(lines(t)), 2)


def _summary_sql(table, cols):
    return " UNION ALL ".join(f"""SELECT '{c}' AS variable, COUNT({c}) AS count,
        round((COUNT(*) - COUNT({c})) * 100.0 / COUNT(*), 4) AS missing_pct, round(avg({c}), 4) AS mean,
        round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS p25,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS median, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS p75,
        CAST(max({c}) AS DOUBLE) AS max FROM {table}""" for c in cols)


@query("e13_numeric_summary", _summary_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))
def _(t):
    out = P.numeric_summary(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return rounded(out, "mean", "std", "p25", "median", "p75", digits=4)


@query("e13b_numeric_summary_nulls", _summary_sql(LINES, ["n_lines", "n_returned", "first_ship"]))
def _(t):
    out = P.numeric_summary(lines(t), ["n_lines", "n_returned", "first_ship"])
    return rounded(out, "mean", "std", "p25", "median", "p75", digits=4)


def _cat_sql(table, cols):
    return " UNION ALL ".join(f"""SELECT '{c}' AS variable, COUNT(*) AS n_categories,
        round(coalesce(SUM(n) FILTER (v IS NULL), 0) * 100.0 / SUM(n), 4) AS missing_pct,
        (list(coalesce(v, '<NA>') ORDER BY n DESC, coalesce(v, '<NA>')))[1] AS top_category,
        max(n) AS top_n, COUNT(*) FILTER (n < 10) AS rare_categories
        FROM (SELECT CAST({c} AS VARCHAR) AS v, COUNT(*) AS n FROM {table} GROUP BY 1)""" for c in cols)


@query("e14_categorical_summary", _cat_sql("(SELECT lang, nullif(source, 'src3') AS source FROM documents)",
                                           ["lang", "source"]))
def _(t):
    docs = t.documents.select("lang", F.nullif("source", F.lit("src3")).alias("source"))
    return P.categorical_summary(docs, ["lang", "source"])


@query("e15_rare_categories", """
    SELECT 'pair' AS variable, list(v ORDER BY n DESC, v)[1:10] AS rare_categories FROM
      (SELECT lang || '-' || source AS v, COUNT(*) AS n FROM documents GROUP BY 1 HAVING COUNT(*) < 10)
    HAVING COUNT(*) > 0""")
def _(t):
    return P.rare_categories(t.documents.select(F.concat_ws("-", "lang", "source").alias("pair")), ["pair"])


def _rare_sql(column, value):
    return f"""SELECT '{column}', 'categorical', 0.0::DOUBLE, NULL, NULL, NULL, NULL, (SELECT CAST(to_json(list(v ORDER BY n DESC, v)) AS VARCHAR)
        FROM (SELECT {value} AS v, COUNT(*) AS n FROM documents GROUP BY 1 HAVING COUNT(*) < 10 ORDER BY n DESC, v LIMIT 10)), NULL
        FROM documents HAVING COUNT(*) > 0"""


@query("e15b_distribution_report", f"""
    SELECT variable, kind, null_pct, min, p25, p50, p75, max, rare_categories FROM (
    SELECT 'n_chars' AS variable, 'numeric' AS kind, 0.0::DOUBLE AS null_pct, CAST(min(n_chars) AS DOUBLE) AS min,
           round(quantile_cont(CAST(n_chars AS DOUBLE), 0.25), 4) AS p25, round(quantile_cont(CAST(n_chars AS DOUBLE), 0.5), 4) AS p50,
           round(quantile_cont(CAST(n_chars AS DOUBLE), 0.75), 4) AS p75, NULL AS rare_categories, CAST(max(n_chars) AS DOUBLE) AS max FROM documents
    UNION ALL {_rare_sql("lang", "lang")} UNION ALL {_rare_sql("shelf", "source || '-' || (n_chars % 997)")})""")
def _(t):
    docs = t.documents.withColumn("shelf", F.concat("source", F.lit("-"), (F.col("n_chars") % 997).cast("string")))
    return rounded(P.distribution_report(docs, ["n_chars"], ["lang", "shelf"]), "p25", "p50", "p75", digits=4)


def _iqr_sql(table, cols):
    return " UNION ALL ".join(f"""SELECT '{c}' AS variable, round(lo, 4) AS lower_iqr, round(hi, 4) AS upper_iqr,
        COUNT(*) FILTER ({c} < lo OR {c} > hi) AS outlier_count,
        round(COUNT(*) FILTER ({c} < lo OR {c} > hi) * 100.0 / COUNT(*), 4) AS outlier_pct FROM {table},
        (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (SELECT
           quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM {table}))
        GROUP BY lo, hi""" for c in cols)


@query("e16_iqr_outliers", _iqr_sql("documents", ["n_chars"]) + " UNION ALL " + _iqr_sql("events", ["value"]))
def _(t):
    out = P.iqr_outliers(t.documents, ["n_chars"]).unionByName(P.iqr_outliers(t.events, ["value"]))
    return rounded(out, "lower_iqr", "upper_iqr", digits=4)


DOCS = """(SELECT d.doc_id, d.lang, nullif(d.source, 'src3') AS source, d.n_chars, length(d.text) AS text_length,
           l.toxic, l.quality FROM documents d JOIN labels l USING (doc_id))"""


def labelled(t):
    docs = t.documents.select("doc_id", "lang", F.nullif("source", F.lit("src3")).alias("source"), "n_chars",
                              F.length("text").cast("bigint").alias("text_length"))
    return docs.join(t.labels, "doc_id")


def _cross_sql(table, cols, y, norm):
    div = {"columns": ("SUM(n0) OVER ()", "SUM(n1) OVER ()"), "index": ("(n0 + n1)", "(n0 + n1)")}[norm]
    return " UNION ALL ".join(f"""SELECT '{c}' AS variable, category, round(n0 / {div[0]}, 6) AS pct_target_0,
        round(n1 / {div[1]}, 6) AS pct_target_1 FROM (SELECT coalesce({c}, '<NA>') AS category,
        COUNT(*) FILTER ({y} = 0) AS n0, COUNT(*) FILTER ({y} = 1) AS n1 FROM {table} GROUP BY 1)""" for c in cols)


@query("e17_crosstab_columns", _cross_sql(DOCS, ["lang", "source"], "toxic", "columns"))
def _(t):
    return rounded(P.crosstab_by_target(labelled(t), ["lang", "source"], "toxic"), "pct_target_0", "pct_target_1")


@query("e18_crosstab_index", _cross_sql(DOCS, ["lang", "source"], "toxic", "index"))
def _(t):
    out = P.crosstab_by_target(labelled(t), ["lang", "source"], "toxic", normalize="index")
    return rounded(out, "pct_target_0", "pct_target_1")


@query("e19_target_corr", " UNION ALL ".join(
    f"SELECT '{c}' AS variable, round(abs(corr({c}, CAST(l_returnflag = 'R' AS INTEGER))), 6) AS abs_corr_target FROM lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    + " UNION ALL SELECT 'constant', NULL FROM (SELECT COUNT(*) FROM lineitem)")
def _(t):
    li = t.lineitem.withColumns({"y": (col("l_returnflag") == "R").cast("int"), "constant": F.lit(3.5)})
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "constant"]
    return rounded(P.target_corr(li, cols, "y"), "abs_corr_target")


PAIRS = ["l_quantity", "half", "shifted", "l_tax"]


def _pairs(t):
    return t.lineitem.select("l_quantity", (F.nullif("l_quantity", F.lit(7.0)) / 2).alias("half"),
                             (col("l_quantity") + col("l_tax") * 20).alias("shifted"), "l_tax", "l_discount",
                             "l_extendedprice", F.lit(1.0).alias("constant"))


def _pairs_sql(cols, at_least):
    table = """(SELECT l_quantity, nullif(l_quantity, 7) / 2 AS half, l_quantity + l_tax * 20 AS shifted, l_tax,
        l_discount, l_extendedprice FROM lineitem)"""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    body = " UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS r FROM {table}" for a, b in pairs)
    return f"SELECT col_a, col_b, round(r, 6) AS corr, round(abs(r), 6) AS abs_corr FROM ({body}) WHERE abs(r) >= {at_least}"


@query("e20_corr_pairs", _pairs_sql(PAIRS, 0.9))
def _(t):
    return rounded(P.corr_pairs(_pairs(t), [*PAIRS, "constant"], 0.9), "corr", "abs_corr")


MANY = [*PAIRS, "l_discount", "l_extendedprice"]


@query("e20b_corr_pairs_many_columns", _pairs_sql(MANY, 0.0))
def _(t):
    return rounded(P.corr_pairs(_pairs(t), [*MANY, "constant"], 0.0), "corr", "abs_corr")


@query("e24_having_zero", """
    SELECT l_orderkey, CAST(SUM(CAST(l_returnflag = 'R' AS INTEGER)) AS BIGINT) AS total FROM lineitem GROUP BY 1
    HAVING SUM(CAST(l_returnflag = 'R' AS INTEGER)) = 0""")
def _(t):
    return P.having_zero(t.lineitem.withColumn("r", (col("l_returnflag") == "R").cast("int")), "l_orderkey", "r")


@query("e25_class_distribution", """
    SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (toxic = 1) AS positives, COUNT(*) FILTER (toxic = 0) AS negatives,
           round(COUNT(*) FILTER (toxic = 1) / COUNT(*), 6) AS positive_rate FROM labels""")
def _(t):
    return rounded(P.class_distribution(t.labels, "toxic"), "positive_rate")


@query("e26_mean_by", """
    SELECT o_orderpriority, o_orderstatus, round(avg(o_totalprice), 4) AS o_totalprice, round(avg(o_custkey), 4) AS o_custkey
    FROM orders GROUP BY ALL""")
def _(t):
    return rounded(P.mean_by(t.orders, ["o_orderpriority", "o_orderstatus"], ["o_totalprice", "o_custkey"]),
                   "o_totalprice", "o_custkey", digits=4)


@query("e26b_max_by_keys", """
    SELECT l_returnflag, l_linenumber, max(l_extendedprice) AS l_extendedprice, max(l_tax) AS l_tax FROM lineitem GROUP BY ALL""")
def _(t):
    return P.max_by_keys(t.lineitem, ["l_returnflag", "l_linenumber"], ["l_extendedprice", "l_tax"])


@query("e27_rate_by_category", f"""
    SELECT source AS category, COUNT(*) AS n, round(avg(toxic), 6) AS rate FROM {DOCS} WHERE source IS NOT NULL
    GROUP BY 1 ORDER BY n DESC, category LIMIT 8""")
def _(t):
    return rounded(P.rate_by_category(labelled(t), "source", "toxic", 8), "rate")


@query("e28_top_categories", """
    SELECT coalesce(nullif(source, 'src3'), '<NA>') AS category, COUNT(*) AS n FROM documents GROUP BY 1
    ORDER BY n DESC, category LIMIT 8""")
def _(t):
    return P.top_categories(t.documents.withColumn("source", F.nullif("source", F.lit("src3"))), "source", 8)


@query("e29_histogram", """
    WITH e AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 25 AS w FROM orders)
    SELECT bin, target, round(lo + (bin - 1) * w, 4) AS bin_start, round(lo + bin * w, 4) AS bin_end, COUNT(*) AS n FROM (
      SELECT CAST(least(floor((o_totalprice - lo) / w), 24) AS INTEGER) + 1 AS bin,
             CAST(o_orderstatus = 'F' AS INTEGER) AS target, lo, w FROM orders, e) GROUP BY bin, target, lo, w""")
def _(t):
    df = t.orders.withColumn("y", (col("o_orderstatus") == "F").cast("int"))
    return rounded(P.histogram(df, "o_totalprice", "y"), "bin_start", "bin_end", digits=4)


@query("e30_error_profile", """
    WITH e AS (SELECT * FROM lineitem WHERE l_returnflag = 'R' AND l_tax > 0.04)
    SELECT * FROM (SELECT 'numeric_mean' AS kind, variable, mean, CAST(NULL AS VARCHAR) AS mode FROM (
        SELECT 'l_quantity' AS variable, round(avg(l_quantity), 4) AS mean FROM e
        UNION ALL SELECT 'l_discount', round(avg(l_discount), 4) FROM e
        UNION ALL SELECT 'l_extendedprice', round(avg(l_extendedprice), 4) FROM e) ORDER BY mean DESC LIMIT 2)
    UNION ALL SELECT 'categorical_mode', 'l_linestatus', NULL,
        (SELECT l_linestatus FROM e GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)
    UNION ALL SELECT 'categorical_mode', 'l_linenumber', NULL,
        (SELECT CAST(l_linenumber AS VARCHAR) FROM e GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)""")
def _(t):
    errors = t.lineitem.filter((col("l_returnflag") == "R") & (col("l_tax") > 0.04))
    return P.error_profile(errors, ["l_quantity", "l_discount", "l_extendedprice"], ["l_linestatus", "l_linenumber"], 2)


@query("e31_missing_by_row", f"""
    SELECT o_orderkey, CAST(n_lines IS NULL AS INTEGER) + CAST(n_returned IS NULL AS INTEGER)
             + CAST(first_ship IS NULL AS INTEGER) AS missing_cols,
           round((CAST(n_lines IS NULL AS INTEGER) + CAST(n_returned IS NULL AS INTEGER)
             + CAST(first_ship IS NULL AS INTEGER)) * 100.0 / 5, 4) AS missing_pct FROM {LINES}""")
def _(t):
    return P.missing_by_row(lines(t), ["o_orderkey"])


@query("e31b_rows_with_missing", f"""
    SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (n_lines IS NULL) AS with_missing,
           COUNT(*) FILTER (n_lines IS NOT NULL) AS without_missing FROM {LINES}""")
def _(t):
    return P.rows_with_missing(lines(t))


GEO = "lpad(CAST(o_custkey AS VARCHAR), 6, '0')"


@query("e32_d07_geo_summary", f"""
    SELECT substr({GEO}, 1, 4) AS province, substr({GEO}, 1, 5) AS district, COUNT(*) AS n_rows,
           COUNT(DISTINCT o_custkey) AS n_units FROM orders GROUP BY ALL""")
def _(t):
    return U.geo_summary(t.orders, "o_custkey", ["o_custkey"], {"province": 4, "district": 5}, 6)


@query("d07_join_counts", """
    SELECT l_returnflag, l_linestatus, COUNT(*) AS n_rows, COUNT(DISTINCT (l_orderkey, l_linenumber)) AS n_units
    FROM lineitem GROUP BY ALL""")
def _(t):
    return U.join_counts(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_returnflag", "l_linestatus"])


# ---------------------------------------------------------------- set operations and shape

@query("h01_union_all", """
    SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment, NULL::VARCHAR AS supplier FROM customer
    UNION ALL SELECT s_suppkey, s_acctbal, NULL, s_name FROM supplier""")
def _(t):
    return R.union_all([
        t.customer.select(col("c_custkey").alias("id"), col("c_acctbal").alias("balance"), col("c_mktsegment").alias("segment")),
        t.supplier.select(col("s_suppkey").alias("id"), col("s_acctbal").alias("balance"), col("s_name").alias("supplier"))])


@query("h02_distinct", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def _(t):
    return R.distinct(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("h03_is_subset", """
    SELECT 'l_returnflag' AS variable, bool_and(l_returnflag IN ('A', 'N', 'R')) AS is_subset FROM lineitem
    UNION ALL SELECT 'l_linenumber', bool_and(l_linenumber IN (0, 1)) FROM lineitem""")
def _(t):
    return R.is_subset(t.lineitem, "l_returnflag", ["A", "N", "R"]).unionByName(
        R.is_subset(t.lineitem, "l_linenumber", [0, 1]))


@query("h05_melt", """
    SELECT l_orderkey, l_linenumber, unnest(['l_discount', 'l_tax']) AS variable, unnest([l_discount, l_tax]) AS value
    FROM lineitem""")
def _(t):
    return R.melt(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_discount", "l_tax"])


@query("h06_pivot_matrix", """
    SELECT user_id, round(click, 4) AS click, round(error, 4) AS error, round((click + error) / 2, 4) AS mean FROM (
      SELECT user_id, coalesce(SUM(value) FILTER (event_type = 'click'), 0) AS click,
             coalesce(SUM(value) FILTER (event_type = 'error'), 0) AS error FROM events GROUP BY 1)
    ORDER BY (click + error) DESC, user_id LIMIT 10""")
def _(t):
    return rounded(R.pivot_matrix(t.events, "user_id", "event_type", "value", ["click", "error"]), "click", "error",
                   "mean", digits=4)


@query("h07_dummy_levels", """
    SELECT 'lang' AS variable, lang AS level, 'lang__' || lang AS expanded_feature, COUNT(*) AS n FROM documents GROUP BY ALL
    UNION ALL SELECT 'source', coalesce(nullif(source, 'src3'), '<NA>'), 'source__' || coalesce(nullif(source, 'src3'), '<NA>'),
      COUNT(*) FROM documents GROUP BY ALL""")
def _(t):
    return R.dummy_levels(t.documents.select("lang", F.nullif("source", F.lit("src3")).alias("source")), ["lang", "source"])


@query("h07b_expand_dummies", """
    SELECT doc_id, CAST(lang = 'de' AS INTEGER) AS lang__de, CAST(lang = 'en' AS INTEGER) AS lang__en,
           CAST(lang = 'es' AS INTEGER) AS lang__es, CAST(lang = 'fr' AS INTEGER) AS lang__fr FROM documents""")
def _(t):
    return R.expand_dummies(t.documents, ["lang"], ["doc_id"])[0]


@query("h07c_long_dummies_many_levels", """
    SELECT o_orderkey, 'o_custkey__' || o_custkey AS expanded_feature, 1 AS flag FROM orders
    UNION ALL SELECT o_orderkey, 'o_totalprice__' || CAST(round(o_totalprice) AS BIGINT), 1 FROM orders""")
def _(t):
    df = t.orders.select("o_orderkey", "o_custkey", F.round("o_totalprice").cast("bigint").alias("o_totalprice"))
    return R.long_dummies(df, ["o_custkey", "o_totalprice"], ["o_orderkey"])
