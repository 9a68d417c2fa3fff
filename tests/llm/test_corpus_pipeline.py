"""The stages of the pipeline against plain versions of what they decide."""

import hashlib
from collections import Counter

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from surveyloom.llm import mixing, pii, quality_rules, simhash


def test_stages(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        out = stage(spark, docs, data)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = (before, docs)
        if name != "tokens":
            assert docs.columns == columns
    before, after = seen["quality"]
    kept = {r[0] for r in quality_rules.verdicts(before).where("kept").select("doc.doc_id").collect()}
    assert {r["doc_id"] for r in after.collect()} == kept
    before, after = seen["near_dedup"]
    groups = {r["doc_id"]: r["component_id"] for r in simhash.groups(before).collect()}
    assert Counter(r["doc_id"] for r in after.collect()) == Counter(set(groups.values()))
    before, after = seen["personal_data"]
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    for r in after.collect():
        assert not [s for s in pii.base_spans(r["text"]) if s[0] != "phone"] and r["n_chars"] == len(r["text"])
        assert r["text"] == texts[r["doc_id"]] or pii._ANCHOR.search(texts[r["doc_id"]])
    before, after = seen["mix"]
    copies = {r["doc_id"]: r["copies"] for r in mixing.plan(before).collect()}
    assert Counter(r["doc_id"] for r in after.collect()) == Counter({k: n for k, n in copies.items() if n})
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    before, after = seen["tokens"]
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    for r in after.collect():
        assert r["ids"] == lib.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["text_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_odd_rows_and_empty_table(spark, data):
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint, taken int"
    rows = [(1, None, "en", "a", 0, 1), (2, "the of and " * 40 + "x " * 20, "en", None, 5, 1), (2, "the of and " * 40 + "x " * 20, "en", None, 5, 1), (None, "", None, None, None, None)]
    for part in (rows, []):
        docs = spark.createDataFrame(part, kind)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, data)
            assert out.count() <= 3 * len(part)
            if name != "tokens":
                assert set(docs.columns) == set(out.columns)
    twice = spark.createDataFrame(rows[1:3], kind)
    assert simhash.keep_one(twice).count() == 1


def test_columns_of_any_name(spark):
    names = ["_n", "_keep", "_d", "_s", "_z", "_positions", "_position", "_size", "keep", "n", "doc", "id", "position", "size"]
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{n} int" for n in names)
    own = tuple(range(len(names)))
    docs = spark.createDataFrame([(k, f"words of text {k} " * 30, "en", "ab"[k % 2], 1, *own) for k in range(6)], kind)
    for stage in (corpus_pipeline.near_dedup, corpus_pipeline.mix):
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        rows = [tuple(r) for r in out.collect()]
        assert rows and all(r[5:] == own for r in rows)
