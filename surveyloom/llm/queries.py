"""One query per operator over the given tables, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import (bpe, chat_tree, filter_audit, importance, language_id, mixing, neighbours, pii, quality_rules, repeats, secret_scan,
               signature_join, simhash)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, tables: str, sql: str | None = None):
    """Register ``fn(whole table, ...) -> DataFrame``."""
    def wrap(fn):
        QUERIES[name] = lambda spark, folder: fn(*[spark.read.parquet(f"{folder}/{t}.parquet") for t in tables.split()])
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return wrap


@query("op1_language_id", "documents")
def _language_id(docs: DataFrame) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    profiles = language_id.learn(docs.where(~F.coalesce(held_out, F.lit(True))))
    rated = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"),
                        language_id.predict(profiles, F.col("text")).alias("_r"))
    return rated.select("doc_id", "held_out", "_r.lang_pred", "_r.score")


@query("op2_quality_rules", "documents")
def _quality_rules(docs: DataFrame) -> DataFrame:
    rated = quality_rules.verdicts(docs)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rated.select("doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept"))


@query("op3_bpe_round_trip", "documents")
def _bpe_round_trip(docs: DataFrame) -> DataFrame:
    model = docs.sparkSession.sparkContext.broadcast(bpe.load(public_tokenizers.path("byte_bpe_50k.json")))
    ids = docs.select("doc_id", bpe.encode(F.col("text"), model).alias("ids"))
    back = ids.withColumn("decoded", bpe.decode(F.col("ids"), model))
    return back.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op4_hilbert_neighbours", "embeddings")
def _hilbert_neighbours(vectors: DataFrame) -> DataFrame:
    return neighbours.search(vectors, F.col("vec_id") % 20 == 0)


@query("op5_chat_tree", "conversations")
def _chat_tree(turns: DataFrame) -> DataFrame:
    odd = "\\### Assistant: </turn> ok"
    extra = turns.sparkSession.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id bigint, turn int, role string, text string")
    back = chat_tree.read_back(*chat_tree.build(turns.select("conv_id", "turn", "role", "text").unionByName(extra)))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return back.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                       F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("bigint").alias("formatted_chars"))


@query("op6_curriculum_mix", "documents")
def _curriculum_mix(docs: DataFrame) -> DataFrame:
    planned = mixing.plan(docs).withColumn("position", F.get("positions", F.lit(0)))
    return planned.orderBy(F.col("position").asc_nulls_last(), "doc_id").select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "position")


@query("op7_simhash", "documents")
def _simhash(docs: DataFrame) -> DataFrame:
    found = simhash.groups(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op8_repeated_bytes", "documents")
def _repeated_bytes(docs: DataFrame) -> DataFrame:
    cut = repeats.remove_repeats(docs)
    removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda a, r: a + r["end"] - r["start"])
    listed = F.array_join(F.transform("removed", lambda r: F.concat_ws(":", r["start"], r["end"])), ",")
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"), "kept_sha256",
                      listed.alias("removed_spans"), F.coalesce(F.try_divide(removed, "n_bytes"), F.lit(0.0)).alias("removed_share"))


@query("op9_personal_data", "documents")
def _personal_data(docs: DataFrame) -> DataFrame:
    weights = pii.train(docs)
    found = docs.select("doc_id", pii.detect(F.col("text"), weights).alias("_r")).select("doc_id", "_r.base", "_r.spans")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in pii.KINDS], F.sha2(secret_scan.listed("base"), 256).alias("base_sha256"),
                        secret_scan.listed("spans").alias("spans"))


@query("op10_secret_scan", "documents")
def _secret_scan(docs: DataFrame) -> DataFrame:
    found = secret_scan.scan(docs)
    return found.select(
        "doc.doc_id", *[secret_scan.how_many("base", k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secret_scan.listed("base"), 256).alias("base_sha256"), secret_scan.listed("spans").alias("spans"))


@query("op11_filter_audit", "documents labels", """
    with docs as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents),
    worded as (select *, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as words,
        min(doc_id) over (partition by text) as least from docs),
    failing as (select doc_id, part,
        len(words) < 100 as a, 100 * len(list_distinct(words)) < 80 * len(words) as b,
        100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) as c,
        regexp_matches(text, '[#$%&*|]') as d, coalesce(doc_id > least, false) as e from worded),
    good as (select doc_id, max(coalesce(quality = 1, false)) as good, max(coalesce(toxic = 1, false)) as toxic from labels group by doc_id),
    masks as (select part, 1 * a::int + 2 * b::int + 4 * c::int + 8 * d::int + 16 * e::int as mask, count(*) as n,
        count(*) filter (where good) as good, count(*) filter (where toxic) as toxic
        from failing left join good using (doc_id) group by all),
    letters as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) t(f, bit)),
    orders as (select p.f || q.f || r.f || s.f || t.f as filter_order, [p.bit, q.bit, r.bit, s.bit, t.bit] as bits
        from letters p, letters q, letters r, letters s, letters t where p.bit + q.bit + r.bit + s.bit + t.bit = 31
        and (p.bit | q.bit | r.bit | s.bit | t.bit) = 31),
    steps as (select filter_order, step, bits[step] as bit, coalesce(list_sum(bits[1:step - 1]), 0)::int as earlier
        from orders, range(1, 6) r(step)),
    sums as (select part, filter_order, step, bit,
        sum(n) filter (where mask & (earlier | bit) = 0) as kept, sum(n) filter (where mask & bit <> 0 and mask & earlier = 0) as removed,
        sum(n) filter (where mask & bit <> 0 and mask & earlier <> 0) as redundant, sum(n) filter (where mask = bit) as unique_fails,
        sum(good) filter (where mask & bit <> 0 and mask & earlier = 0) as good_lost,
        sum(toxic) filter (where mask & bit <> 0 and mask & earlier = 0) as toxic_lost
        from masks, steps group by all),
    values_of as (select part, bit, sum(removed) as shapley from sums group by all)
    select part, filter_order, step::int as step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed,
        coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails, coalesce(good_lost, 0)::bigint as good_lost,
        coalesce(toxic_lost, 0)::bigint as toxic_lost, coalesce(shapley, 0)::bigint as shapley
    from sums join values_of using (part, bit)""")
def _filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return filter_audit.audit(docs, labels)


@query("op12_importance_resampling", "documents benchmark")
def _importance_resampling(docs: DataFrame, target: DataFrame) -> DataFrame:
    return importance.resample(docs, target)


@query("op13_jaccard_join", "documents")
def _jaccard_join(docs: DataFrame) -> DataFrame:
    return signature_join.join(docs)
