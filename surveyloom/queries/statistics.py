"""Feature statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stats as S
from .aggregates import DOCS, LINES, labelled, lines, rounded
from .registry import query


@query("k01_median_fill", f"""
    SELECT o_orderkey, coalesce(n_lines, (SELECT quantile_cont(CAST(n_lines AS DOUBLE), 0.5) FROM {LINES})) AS n_lines,
           coalesce(first_ship, (SELECT quantile_cont(first_ship, 0.5) FROM {LINES})) AS first_ship, 0.0::DOUBLE AS empty
    FROM {LINES}""")
def _(t):
    df = lines(t).select("o_orderkey", "n_lines", "first_ship", F.lit(None).cast("double").alias("empty"))
    return S.median_fill(df, ["n_lines", "first_ship", "empty"])


def f_sql(value, y, table):
    return f"""(SELECT SUM(nc * (m - g) * (m - g)) / (COUNT(*) - 1) / (SUM(w) / (SUM(nc) - COUNT(*))) FROM (
        SELECT COUNT(*) AS nc, avg({value}) AS m, var_pop({value}) * COUNT(*) AS w,
               (SELECT avg({value}) FROM {table}) AS g FROM {table} GROUP BY {y}))"""


def anova_docs_sql(cats=("lang", "source")):
    rows = [f"SELECT '{c}' AS expanded_feature, '{c}' AS variable, 'numeric' AS expansion, {f_sql(c, 'toxic', DOCS)} AS f"
            for c in ("n_chars", "text_length", "quality")]
    # a 0/1 dummy: mean k/n and variance k/n - (k/n)^2 per class, from the joint counts
    for c in cats:
        rows.append(f"""SELECT '{c}__' || level, '{c}', 'dummy',
            SUM(n * (p - g) * (p - g)) / 1.0 / (SUM(n * p * (1 - p)) / (SUM(n) - 2)) FROM (
              SELECT level, y, n, k / n AS p, SUM(k) OVER (PARTITION BY level) / SUM(n) OVER (PARTITION BY level) AS g FROM (
                SELECT level, y, n, (SELECT COUNT(*) FROM {DOCS} d WHERE coalesce(d.{c}, '<NA>') = level AND d.toxic = y) AS k
                FROM (SELECT DISTINCT coalesce({c}, '<NA>') AS level FROM {DOCS}),
                     (SELECT toxic AS y, COUNT(*) AS n FROM {DOCS} GROUP BY 1))) GROUP BY level""")
    return " UNION ALL ".join(rows)


@query("k02_anova_f", f"""
    SELECT expanded_feature, variable, expansion, round(coalesce(f, 0), 6) AS f_score FROM ({anova_docs_sql()})
    UNION ALL SELECT 'fixed', 'fixed', 'numeric', 0.0 FROM (SELECT COUNT(*) FROM documents)""")
def _(t):
    df = labelled(t).withColumn("fixed", F.lit(2.0))
    out = S.anova_f(df, ["n_chars", "text_length", "quality", "fixed"], ["lang", "source"], "toxic", p_values=False)
    return rounded(out, "f_score")


@query("k02b_anova_f_many_classes", f"""
    SELECT c AS expanded_feature, c AS variable, 'numeric' AS expansion, round(f, 6) AS f_score FROM (
      SELECT 'l_quantity' AS c, {f_sql("l_quantity", "l_linenumber", "lineitem")} AS f
      UNION ALL SELECT 'l_extendedprice', {f_sql("l_extendedprice", "l_linenumber", "lineitem")}
      UNION ALL SELECT 'l_tax', {f_sql("l_tax", "l_linenumber", "lineitem")})""")
def _(t):
    return rounded(S.anova_f(t.lineitem, ["l_quantity", "l_extendedprice", "l_tax"], [], "l_linenumber", p_values=False),
                   "f_score")


@query("k03_anova_p_values", f"""
    SELECT expanded_feature, true AS p_in_range, true AS consistent FROM ({anova_docs_sql()})""")
def _(t):
    """p-values lie in [0, 1], agree with the flag, and fall as F rises (all
    features here have the same degrees of freedom)."""
    from pyspark.sql import Window

    out = S.anova_f(labelled(t), ["n_chars", "text_length", "quality"], ["lang", "source"], "toxic")
    below = F.lag("p_value").over(Window.orderBy("f_score"))  # one row per feature
    p = F.col("p_value")
    return out.select("expanded_feature", F.coalesce(p.between(0, 1), F.lit(True)).alias("p_in_range"), F.coalesce(
        (p <= below) & (F.col("significant_5pct") == (p < 0.05)), F.lit(True)).alias("consistent"))


def _three_class_sql(column):
    """With two degrees of freedom between the classes the tail has a closed form."""
    return f"""SELECT '{column}' AS expanded_feature, round(f, 4) AS f_score, round(pow(1 + 2 * f / d2, -d2 / 2), 6) AS p_value
    FROM (SELECT sum(n * (m - g) * (m - g)) / 2 / (sum(n * v) / (sum(n) - 3)) AS f, sum(n) - 3 AS d2
      FROM (SELECT count(*) AS n, avg({column}) AS m, var_pop({column}) AS v FROM orders GROUP BY o_orderstatus),
           (SELECT avg({column}) AS g FROM orders))"""


@query("k03b_p_values_of_three_classes", " UNION ALL ".join(map(_three_class_sql, ("o_totalprice", "o_custkey", "o_orderkey"))))
def _(t):
    out = S.anova_f(t.orders, ["o_totalprice", "o_custkey", "o_orderkey"], [], "o_orderstatus")
    return out.select("expanded_feature", F.round("f_score", 4).alias("f_score"), F.round("p_value", 6).alias("p_value"))


@query("k04_aggregate_scores", f"""
    SELECT *, rank() OVER (ORDER BY f_score_max DESC) AS rank_f_score FROM (
      SELECT variable, COUNT(*) AS expanded_features, round(max(coalesce(f, 0)), 4) AS f_score_max,
             round(avg(coalesce(f, 0)), 4) AS f_score_mean, COUNT(*) FILTER (coalesce(f, 0) = 0) AS constant_expanded_features
      FROM ({anova_docs_sql()}) GROUP BY variable)""")
def _(t):
    scores = S.anova_f(labelled(t), ["n_chars", "text_length", "quality"], ["lang", "source"], "toxic")
    out = S.aggregate_scores(scores).select("variable", "expanded_features", "f_score_max", "f_score_mean",
                                            "constant_expanded_features", "rank_f_score")
    return rounded(out, "f_score_max", "f_score_mean", digits=4)


@query("k05_select_k_best")
def _(t):
    scores = S.anova_f(labelled(t), ["n_chars", "text_length", "quality"], ["lang", "source"], "toxic")
    return S.select_k_best(labelled(t), S.aggregate_scores(scores), 3, ["doc_id", "toxic"])


@query("k06_ordinal_encode", """
    SELECT doc_id, lang, source, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS lang_code,
           CAST(dense_rank() OVER (ORDER BY coalesce(source, '<NA>')) - 1 AS INTEGER) AS source_code
    FROM (SELECT doc_id, lang, nullif(source, 'src3') AS source FROM documents)""")
def _(t):
    docs = t.documents.select("doc_id", "lang", F.nullif("source", F.lit("src3")).alias("source"))
    return S.ordinal_encode(docs, ["lang", "source"])


CODED = f"""(SELECT toxic, dense_rank() OVER (ORDER BY lang) - 1 AS lang,
    dense_rank() OVER (ORDER BY coalesce(source, '<NA>')) - 1 AS source FROM {DOCS})"""


@query("k07_anova_ordinal", f"""
    SELECT c AS expanded_feature, c AS variable, 'ordinal' AS expansion, round(f, 5) AS f_score FROM (
      SELECT 'lang' AS c, {f_sql("lang", "toxic", CODED)} AS f UNION ALL SELECT 'source', {f_sql("source", "toxic", CODED)})""")
def _(t):
    return rounded(S.anova_f(labelled(t), [], ["lang", "source"], "toxic", encode="ordinal", p_values=False), "f_score",
                   digits=5)


def mi_sql(level, y, table):
    return f"""(SELECT greatest(0, SUM(n * ln(n * t / (a * b))) / max(t)) FROM (
        SELECT n, SUM(n) OVER () AS t, SUM(n) OVER (PARTITION BY v) AS a, SUM(n) OVER (PARTITION BY y) AS b FROM (
          SELECT {level} AS v, {y} AS y, COUNT(*)::DOUBLE AS n FROM {table} GROUP BY 1, 2)))"""


EDGES = "(SELECT quantile_cont(n_chars::DOUBLE, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM " + DOCS + ")"
BINNED = f"(SELECT toxic, len(list_filter(q, lambda e: e < n_chars)) AS bin FROM {DOCS}, {EDGES})"


@query("k08_mutual_info", f"""
    SELECT 'lang' AS variable, round({mi_sql("lang", "toxic", DOCS)}, 6) AS mutual_info
    UNION ALL SELECT 'source', round({mi_sql("coalesce(source, '<NA>')", "toxic", DOCS)}, 6)
    UNION ALL SELECT 'n_chars', round({mi_sql("bin", "toxic", BINNED)}, 6)""")
def _(t):
    return rounded(S.mutual_info(labelled(t), ["lang", "source"], ["n_chars"], "toxic"), "mutual_info")


# brute force over all pairs of labelled documents; digamma of whole numbers as harmonic sums
NEAREST = f"""(SELECT a.doc_id, any_value(a.n_chars) AS x, any_value(a.toxic) AS y, COUNT(*) AS others,
    CASE WHEN list_sort(list(abs(a.n_chars - b.n_chars)))[least(3, COUNT(*))] = 0 THEN COUNT(*) FILTER (a.n_chars = b.n_chars) + 1
         ELSE least(3, COUNT(*)) END AS k,
    list_sort(list(abs(a.n_chars - b.n_chars)))[least(3, COUNT(*))] AS r
    FROM {DOCS} a JOIN {DOCS} b ON a.toxic = b.toxic AND a.doc_id <> b.doc_id GROUP BY a.doc_id)"""
PSI = "(coalesce(list_sum(list_transform(range(1, ({n})::BIGINT), lambda j: 1.0 / j)), 0) - 0.57721566490153286)"


@query("k08b_neighbour_information", f"""
    SELECT 'n_chars' AS variable, round(greatest(0, {PSI.format(n="COUNT(*)")} + avg(p)), 6) AS mutual_info FROM (
      SELECT {PSI.format(n="k")} - {PSI.format(n="others + 1")} - {PSI.format(n="m")} AS p FROM (
        SELECT any_value(a.k) AS k, any_value(a.others) AS others,
               COUNT(*) FILTER (abs(a.x - b.x) < a.r OR (a.r = 0 AND a.x = b.x)) AS m
        FROM {NEAREST} a, {NEAREST} b GROUP BY a.doc_id))""")
def _(t):
    return rounded(S.neighbour_information(labelled(t), ["n_chars"], "toxic"), "mutual_info")


@query("k10_available_specs", f"""
    SELECT 'n_lines' AS variable, 'size' AS "group", 'numeric' AS kind,
           round((COUNT(*) - COUNT(n_lines)) * 100.0 / COUNT(*), 4) AS null_pct FROM {LINES}
    UNION ALL SELECT 'o_orderpriority', 'context', 'categorical', 0.0 FROM {LINES} HAVING COUNT(*) > 0""")
def _(t):
    specs = t._spark.createDataFrame([("n_lines", "size", "numeric"), ("o_orderpriority", "context", "categorical"),
                                      ("absent", "size", "numeric"), ("n_lines", "zzz", "repeat")],
                                     "variable string, group string, kind string")
    return S.available_specs(lines(t), specs)


@query("k05b_selected_variables", f"""
    SELECT variable, rank() OVER (ORDER BY m DESC) AS rank_f_score FROM (
      SELECT variable, max(coalesce(f, 0)) AS m FROM ({anova_docs_sql()}) GROUP BY 1) ORDER BY m DESC, variable LIMIT 3""")
def _(t):
    from ..operators.ordered import top_k

    scores = S.anova_f(labelled(t), ["n_chars", "text_length", "quality"], ["lang", "source"], "toxic", p_values=True)
    ranked = S.aggregate_scores(scores)
    return top_k(ranked, [("f_score_max", "desc"), ("variable", "asc")], 3).select("variable", "rank_f_score")
