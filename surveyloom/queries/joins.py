"""Joins and key-based rankings."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ..operators.joins import (
    align_series,
    attach_metadata,
    left_join,
    lookup_first,
    mark_exists,
    merge_all,
    merge_with_audit,
    missing_from,
)
from ..operators.neighbours import knn_join
from ..operators.ordered import (
    best_per_group,
    best_per_objective,
    dedup_first,
    distinct_ordered,
    first_per_group,
    mean_rank,
    rank_min,
    share,
    top_k,
    top_k_exclusive,
)
from .registry import query

ORDER_SUMS = """SELECT l_orderkey AS o_orderkey, COUNT(*) AS n_lines, COUNT(DISTINCT l_partkey) AS n_parts,
    COUNT(*) FILTER (l_returnflag = 'R') AS n_returned FROM lineitem GROUP BY l_orderkey"""


def order_sums(t):
    return t.lineitem.groupBy(col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_distinct("l_partkey").alias("n_parts"),
        F.count_if(col("l_returnflag") == "R").alias("n_returned"))


@query("a00_priority_rates", f"""
    SELECT o_orderpriority, COUNT(*) AS n_orders, CAST(SUM(coalesce(n_lines, 0)) AS BIGINT) AS n_lines,
           CAST(SUM(CASE WHEN n_returned > 0 THEN 1 ELSE 0 END) AS BIGINT) AS any_returned,
           round(avg(CAST(o_orderstatus = 'F' AS INTEGER)), 6) AS target_rate
    FROM orders LEFT JOIN ({ORDER_SUMS}) USING (o_orderkey) GROUP BY o_orderpriority""")
def _(t):
    """Flagship: roll-up, validated one-to-one join, target rate per category."""
    merged, _audit = merge_with_audit(t.orders, order_sums(t), ["o_orderkey"], "lineitem_rollup")
    return merged.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(F.coalesce("n_lines", F.lit(0))).alias("n_lines"),
        F.count_if(col("n_returned") > 0).alias("any_returned"),
        F.round(F.avg((col("o_orderstatus") == "F").cast("int")), 6).alias("target_rate"))


@query("d01_left_join", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, p_brand, p_size FROM lineitem
    LEFT JOIN part ON l_partkey = p_partkey AND l_linenumber = p_size""")
def _(t):
    p = t.part.select(col("p_partkey").alias("l_partkey"), col("p_size").alias("l_linenumber"), "p_brand",
                      col("p_size"))
    return left_join(t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"), p,
                     ["l_partkey", "l_linenumber"])


@query("d02_merge_with_audit", f"""
    SELECT o_orderkey, o_custkey, n_lines, n_parts, n_returned FROM orders LEFT JOIN ({ORDER_SUMS}) USING (o_orderkey)""")
def _(t):
    base = t.orders.select("o_orderkey", "o_custkey")
    addon = order_sums(t).withColumn("o_custkey", F.lit(-1))  # the base keeps its own column
    return merge_with_audit(base, addon, ["o_orderkey"], "rollup")[0]


@query("d02b_merge_audit_row", """
    SELECT 'rollup' AS merge_name, (SELECT COUNT(*) FROM orders) AS base_rows_before,
           (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem) AS addon_rows,
           (SELECT COUNT(*) FROM orders) AS rows_after_merge, CAST(0 AS BIGINT) AS duplicated_after_merge,
           'n_lines|n_parts|n_returned' AS new_columns_added""")
def _(t):
    return merge_with_audit(t.orders, order_sums(t), ["o_orderkey"], "rollup")[1]


FLAGS = """SELECT l_orderkey AS o_orderkey, MAX(CAST(l_linestatus = 'F' AS INTEGER)) AS any_f FROM lineitem GROUP BY 1"""
QTY = """SELECT l_orderkey AS o_orderkey, MAX(l_quantity) AS max_qty FROM lineitem GROUP BY 1"""


def _addons(t):
    li = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    return {"sums": order_sums(t),
            "flags": li.groupBy("o_orderkey").agg(F.max((col("l_linestatus") == "F").cast("int")).alias("any_f")),
            "quantity": li.groupBy("o_orderkey").agg(F.max("l_quantity").alias("max_qty"))}


@query("d03_merge_all", f"""
    SELECT o_orderkey, o_orderstatus, n_lines, n_parts, n_returned, any_f, max_qty FROM orders
    LEFT JOIN ({ORDER_SUMS}) USING (o_orderkey) LEFT JOIN ({FLAGS}) USING (o_orderkey)
    LEFT JOIN ({QTY}) USING (o_orderkey)""")
def _(t):
    return merge_all(t.orders.select("o_orderkey", "o_orderstatus"), _addons(t), ["o_orderkey"])[0]


@query("d03b_merge_all_audit", """
    SELECT m AS merge_name, c AS new_columns_added, (SELECT COUNT(*) FROM orders) AS base_rows_before,
           (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem) AS addon_rows,
           (SELECT COUNT(*) FROM orders) AS rows_after_merge, CAST(0 AS BIGINT) AS duplicated_after_merge
    FROM (VALUES ('sums', 'n_lines|n_parts|n_returned'), ('flags', 'any_f'), ('quantity', 'max_qty')) AS v(m, c)""")
def _(t):
    return merge_all(t.orders.select("o_orderkey", "o_orderstatus"), _addons(t), ["o_orderkey"])[1]


@query("d04_mark_exists", """
    SELECT o_orderkey, CAST(o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS INTEGER) AS has_return
    FROM orders""")
def _(t):
    keys = t.lineitem.filter(col("l_returnflag") == "R").select(col("l_orderkey").alias("o_orderkey"))
    return mark_exists(t.orders.select("o_orderkey"), keys, ["o_orderkey"], "has_return")


@query("d05_attach_metadata", """
    SELECT c_custkey, c_nationkey, coalesce(CASE WHEN n_regionkey < 3 THEN n_name END, '') AS description,
           coalesce(CASE WHEN n_regionkey < 3 THEN n_regionkey END, -1) AS dimension
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def _(t):
    meta = t.nation.filter("n_regionkey < 3").select(col("n_nationkey").alias("c_nationkey"),
                                                     col("n_name").alias("description"), col("n_regionkey").alias("dimension"))
    return attach_metadata(t.customer.select("c_custkey", "c_nationkey"), meta, "c_nationkey",
                           {"description": "", "dimension": -1})


@query("d06_lookup_first", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice, coalesce(
        CASE WHEN p_size < 10 THEN p_brand END, CASE WHEN s_acctbal > 5000 THEN s_name END, l_returnflag) AS source
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey""")
def _(t):
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag")
    return lookup_first(li, [(t.part.filter("p_size < 10"), "p_partkey", "p_brand", "l_partkey"),
                             (t.supplier.filter("s_acctbal > 5000"), "s_suppkey", "s_name", "l_suppkey")],
                        "source", col("l_returnflag")).drop("l_returnflag")


@query("d08_missing_from", """
    SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def _(t):
    return missing_from(t.orders.select("o_orderkey"), t.lineitem.select(col("l_orderkey").alias("o_orderkey")),
                        ["o_orderkey"])


@query("d09_align_series", """
    SELECT coalesce(a.k, b.k) AS user_id, coalesce(a.v, 0.0) AS clicks, coalesce(b.v, 0.0) AS errors FROM
      (SELECT user_id AS k, round(SUM(value), 4) AS v FROM events WHERE event_type = 'click' GROUP BY 1) a
      FULL JOIN (SELECT user_id AS k, round(SUM(value), 4) AS v FROM events WHERE event_type = 'error' GROUP BY 1) b
      ON a.k = b.k""")
def _(t):
    def series(kind):
        return t.events.filter(col("event_type") == kind).groupBy("user_id").agg(F.sum("value").alias("v"))

    out = align_series({"clicks": series("click"), "errors": series("error")}, "user_id", "v")
    return out.select("user_id", F.round("clicks", 4).alias("clicks"), F.round("errors", 4).alias("errors"))


@query("d10_knn_join", """
    SELECT id, neighbour_id, distance, rank FROM (
      SELECT a.vec_id AS id, b.vec_id AS neighbour_id,
             round(sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])))), 6) AS distance,
             CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY
               list_sum(list_transform(list_zip(a.v, b.v), lambda x: (x[1] - x[2]) * (x[1] - x[2]))), b.vec_id) AS INTEGER) AS rank
      FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) a
      JOIN (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) b
        ON a.vec_id <> b.vec_id) WHERE rank <= 5""")
def _(t):
    near = knn_join(t.embeddings, "vec_id", "embedding", 5)
    return near.select("id", "neighbour_id", F.round("distance", 6).alias("distance"), "rank")


# ---------------------------------------------------------------- window and ranking

LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate"


@query("f01_first_per_group", f"""
    SELECT l_orderkey, l_linenumber AS person, l_returnflag, l_quantity FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) AS i FROM lineitem
      WHERE l_returnflag = 'R') WHERE i = 1""")
def _(t):
    heads = t.lineitem.filter(col("l_returnflag") == "R")
    return first_per_group(heads, ["l_orderkey"], LINE_ORDER.split(", "),
                           keep=["l_linenumber", "l_returnflag", "l_quantity"]).withColumnRenamed("l_linenumber", "person")


@query("f02_head_audit", """
    SELECT l_orderkey, COUNT(*) FILTER (l_returnflag = 'R') AS n_heads FROM lineitem GROUP BY l_orderkey
    HAVING COUNT(*) FILTER (l_returnflag = 'R') <> 1""")
def _(t):
    from ..operators.rollup import head_audit

    return head_audit(t.lineitem, ["l_orderkey"], col("l_returnflag") == "R")


@query("f03_rank_min", """
    SELECT l_orderkey, l_linenumber, l_quantity, rank() OVER (ORDER BY l_quantity DESC) AS rank_f FROM lineitem""")
def _(t):
    return rank_min(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), "l_quantity", "rank_f")


@query("f04_mean_rank", """
    SELECT p_partkey, rank() OVER (ORDER BY p_retailprice DESC) AS rank_p_retailprice,
           rank() OVER (ORDER BY p_size DESC) AS rank_p_size,
           (rank() OVER (ORDER BY p_retailprice DESC) + rank() OVER (ORDER BY p_size DESC)) / 2.0 AS mean_rank FROM part""")
def _(t):
    return mean_rank(t.part, "p_retailprice", "p_size").select("p_partkey", "rank_p_retailprice", "rank_p_size", "mean_rank")


@query("f05_share_of_total", """
    SELECT o_orderkey, round(o_totalprice / SUM(o_totalprice) OVER () * 1000000, 4) AS share_ppm FROM orders""")
def _(t):
    return share(t.orders, "o_totalprice").select("o_orderkey", F.round(col("share") * 1000000, 4).alias("share_ppm"))


@query("f06_dedup_first", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity,
        l_extendedprice) AS i FROM lineitem) WHERE i = 1""")
def _(t):
    return dedup_first(t.lineitem, ["l_orderkey", "l_linenumber"],
                       ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"],
                       keep=["l_partkey", "l_suppkey", "l_quantity"])


@query("f07_distinct_ordered", """
    SELECT o_custkey, MIN(o_orderkey) AS first_seen FROM orders GROUP BY o_custkey ORDER BY 2, 1 LIMIT 10""")
def _(t):
    return distinct_ordered(t.orders, "o_custkey", "o_orderkey", 10)


@query("g01_top_k", """
    SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
    ORDER BY o_orderpriority ASC, o_totalprice DESC, o_orderkey LIMIT 25""")
def _(t):
    return top_k(t.orders, [("o_orderpriority", "asc"), ("o_totalprice", "desc"), ("o_orderkey", "asc")], 25).select(
        "o_orderkey", "o_orderpriority", "o_totalprice")


PARTS = """SELECT p_brand || '/' || p_type AS variable, round(SUM(p_retailprice), 4) AS score FROM part GROUP BY 1"""
GROUPS = [["Brand#1/PROMO", "Brand#2/PROMO", "Brand#3/PROMO"], ["Brand#4/SMALL", "Brand#5/SMALL", "Brand#4/LARGE"]]
MARK = "CASE " + " ".join(
    "WHEN variable IN (" + ", ".join(f"'{m}'" for m in g) + f") THEN 'group{i}'" for i, g in enumerate(GROUPS)) + \
    " ELSE 'item' || variable END"


@query("g02_top_k_exclusive", f"""
    SELECT variable, score, rank_f FROM (
      SELECT *, row_number() OVER (PARTITION BY g ORDER BY rank_f, variable) AS i FROM (
        SELECT *, rank() OVER (ORDER BY score DESC) AS rank_f, {MARK} AS g FROM ({PARTS}))) WHERE i = 1
    ORDER BY rank_f, variable LIMIT 28""")
def _(t):
    scores = t.part.groupBy(F.concat_ws("/", "p_brand", "p_type").alias("variable")).agg(
        F.round(F.sum("p_retailprice"), 4).alias("score"))
    return top_k_exclusive(rank_min(scores, "score", "rank_f"), "variable", "rank_f", GROUPS, 28).select(
        "variable", "score", "rank_f")


SUMMARY = """SELECT o_custkey % 7 AS feature_set, o_orderpriority AS model, o_orderstatus AS strategy,
    COUNT(*) AS n, round(avg(CAST(o_totalprice > 250000 AS INTEGER)), 6) AS recall,
    round(avg(CAST(o_custkey % 3 = 0 AS INTEGER)), 6) AS precision,
    round(avg(CAST(o_orderkey % 5 = 0 AS INTEGER)), 6) AS f1 FROM orders GROUP BY 1, 2, 3"""


def summary(t):
    def rate(cond):
        return F.round(F.avg(cond.cast("int")), 6)

    return t.orders.groupBy((col("o_custkey") % 7).alias("feature_set"), col("o_orderpriority").alias("model"),
                            col("o_orderstatus").alias("strategy")).agg(
        F.count(F.lit(1)).alias("n"), rate(col("o_totalprice") > 250000).alias("recall"),
        rate(col("o_custkey") % 3 == 0).alias("precision"), rate(col("o_orderkey") % 5 == 0).alias("f1"))


TIE = "feature_set, model, strategy"


@query("g03_best_per_objective", f"""
    SELECT * FROM (SELECT 'max_detection' AS objective, * FROM ({SUMMARY}) WHERE precision >= 0.25
                   ORDER BY recall DESC, f1 DESC, {TIE} LIMIT 1)
    UNION ALL SELECT * FROM (SELECT 'best_balance', * FROM ({SUMMARY}) ORDER BY f1 DESC, recall DESC, {TIE} LIMIT 1)
    UNION ALL SELECT * FROM (SELECT 'no_leakage', * FROM ({SUMMARY}) WHERE feature_set IN (2, 3)
                   ORDER BY precision DESC, f1 DESC, recall DESC, {TIE} LIMIT 1)""")
def _(t):
    return best_per_objective(summary(t), [
        {"label": "max_detection", "where": col("precision") >= 0.25, "by": ["recall", "f1"]},
        {"label": "best_balance", "by": ["f1", "recall"]},
        {"label": "no_leakage", "where": col("feature_set").isin(2, 3), "by": ["precision", "f1", "recall"]}],
        ["feature_set", "model", "strategy"])


@query("g04_best_per_group", f"""
    SELECT feature_set, model, strategy, f1 FROM (SELECT *, row_number() OVER (PARTITION BY feature_set
      ORDER BY f1 DESC, model, strategy) AS i FROM ({SUMMARY})) WHERE i = 1""")
def _(t):
    return best_per_group(summary(t), ["feature_set"], "f1", ["model", "strategy"]).select(
        "feature_set", "model", "strategy", "f1")
