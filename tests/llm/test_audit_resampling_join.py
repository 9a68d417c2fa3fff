"""Filter audit, importance resampling and Jaccard join against brute-force versions, on
odd rows (nulls, empty texts, ties, repeated rows, clashing columns) and groups of copies."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations, permutations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from surveyloom.llm import filter_audit, importance, signature_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
KIND = "doc_id bigint, text string, lang string, mask int, h1 string, n int, part int, `key` int, root int, _at int, rank int, maybe int"


def texts():
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(3000)] + ["Über", "naïve", "$5", "A*B", "THE"]
    base = [rng.choice(vocabulary) for _ in range(130)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    out = [None, "", " \t\n", "one", "one", "two words", "TWO words", "a b c", "a b c d", "A B C D", "x " * 200, "\x1cx\x1cy z", "é " * 30]
    for k in range(60):   # near copies of one text, some linked only in steps
        words = list(base)
        for _ in range(k % 4):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(words))
    out += [" ".join(base)] * 5
    chain = list(base)
    for k in range(12):
        chain[10 * k] = f"step{k}"
        out.append(" ".join(chain))
    out += [" ".join([rng.choice(vocabulary) for _ in range(rng.choice([5, 40, 200]))] + passage) for _ in range(40)]
    return out + [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 90, 400]))) for _ in range(60)]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(7)
    rows = [(k, t, rng.choice(["en", "de", "", None])) for k, t in enumerate(texts())]
    rng.shuffle(rows)
    rows += [rows[0], rows[0], (rows[1][0], "another text of the same id", "en"), (None, "one", "en"), (None, rows[2][1], None), (-3, "Ein " * 7, "de")]
    return rows


@pytest.fixture(scope="module")
def table(spark, docs):
    return spark.createDataFrame([(*r, *[1] * 9) for r in docs], KIND.replace("h1 string", "h1 int")).repartition(4)


def fails(text):
    words = WORD.findall(text)
    return {f for f, bad in (("A", len(words) < 100), ("B", 100 * len(set(words)) < 80 * len(words)),
                             ("C", 100 * len(re.findall("[A-Z]", text)) > 10 * len(text)), ("D", bool(re.search("[#$%&*|]", text)))) if bad}


def test_filter_audit(spark, docs, table):
    rng = random.Random(1)
    labels = [(rng.choice([None, *range(240)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(200)]
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    sets = [(la or "", fails(t or "") | ({"E"} if i is not None and i > least[t or ""] else set()), i) for i, t, la in docs]
    wanted = {}
    for part in {p for p, _, _ in sets}:
        mine = [(s, i) for p, s, i in sets if p == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                gone = [(s, i) for s, i in left if f in s]
                left = [(s, i) for s, i in left if f not in s]
                shapley[f] += len(gone)
                wanted[part, "".join(order), k + 1] = [len(left), len(gone), sum(f in s for s, _ in mine) - len(gone), sum(s == {f} for s, _ in mine),
                                                       sum(i in good for _, i in gone), sum(i in toxic for _, i in gone), f]
        for key, row in wanted.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]]
    label_table = spark.createDataFrame([(*r, "clash") for r in labels], "doc_id bigint, quality int, toxic int, part string")
    found = filter_audit.audit(table, label_table)
    assert found.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {tuple(r)[:3]: list(r)[3:] for r in found.collect()} == wanted


def test_sketch_clears_no_repeated_text(spark):
    rows = spark.range(40_000).select(F.xxhash64(F.col("id") % 30_000).alias("h1"), F.xxhash64(F.lit(1), F.col("id") % 30_000).alias("h2"), "id")
    bits = spark.sparkContext.broadcast(filter_audit.repeated_cells(rows.repartition(5), 1 << 18))
    test = filter_audit.maybe_repeated(bits, 1 << 18)
    found = rows.select("id", test("h1", "h2").alias("maybe")).groupBy((F.col("id") % 30_000 < 10_000).alias("twice")).agg(F.avg(F.col("maybe").cast("int")).alias("m"))
    share = {r["twice"]: r["m"] for r in found.collect()}
    assert share[True] == 1.0 and share[False] < 0.2


def test_importance_resampling(spark, docs, table):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall((t or "").translate(LOWER))
    bucket = lambda w: zlib.crc32(w.encode()) % 10_000
    wanted_texts = ["w1 w2 w3 THE naïve w1", None, "", "w2 w2"]
    s, t = (Counter(bucket(w) for x in part for w in split(x)) for part in ([x for _, x, _ in docs], wanted_texts))
    n, m = sum(s.values()), sum(t.values())
    rows = []
    for i, x, _ in docs:
        found = [math.floor(1000 * math.log((t[b] + 1) * (n + 10_000) / ((s[b] + 1) * (m + 10_000)))) for b in map(bucket, split(x))]
        weight = sum(found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    drawn = len(fit) * 10 // 100
    wanted = [(*r, None) for r in rows if r[1] < 20] + [(*r, k + 1 if k < drawn else None) for k, r in enumerate(fit)]
    target = spark.createDataFrame([(x, 1) for x in wanted_texts], "text string, id int")
    found = importance.resample(table, target).collect()
    assert Counter(map(tuple, found)) == Counter(wanted) and drawn > 3
    assert {r["weight"] for r in importance.resample(table, target.limit(0)).collect()} != {0}


@pytest.mark.parametrize("digit_bits, block_bits", [(3, 4), (16, 20), (64, 3)])
def test_radix_rank_is_the_sorted_place(spark, digit_bits, block_bits):
    rng = random.Random(digit_bits)
    rows = [(rng.choice([-5, 0, 7, 7, 7]), rng.choice([-(1 << 63), -1, 0, 5, (1 << 63) - 1, rng.randrange(1000)]), k) for k in range(400)]
    df = spark.createDataFrame(rows, "a bigint, b bigint, k int").repartition(3)
    df = df.withColumns({"x": importance.ordered_bits(F.col("a"), descending=True), "y": importance.ordered_bits(F.col("b"))})
    if digit_bits == 64:
        digit_bits = 30
    found = importance.radix_rank(df, ["x", "y"], "place", digit_bits, block_bits).orderBy("place").collect()
    assert [r["place"] for r in found] == list(range(1, 401))
    assert [(r["a"], r["b"]) for r in found] == sorted([r[:2] for r in rows], key=lambda r: (-r[0], r[1]))
    alike = spark.range(5).select(F.lit(3).cast("bigint").alias("x"))
    assert sorted(r["rank"] for r in importance.radix_rank(alike, ["x"]).collect()) == [1, 2, 3, 4, 5]
    assert importance.radix_rank(alike.limit(1), ["x"]).collect()[0]["rank"] == 1
    assert importance.radix_rank(alike.limit(0), ["x"]).collect() == []


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[k:k + 4]) for k in range(max(1, len(words) - 3))) if words else frozenset()


@pytest.mark.parametrize("block", [8, 1024])
def test_jaccard_join(spark, docs, table, block):
    sets = [(i, shingle_set(t)) for i, t, _ in docs]
    root = list(range(len(sets)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k
    for a, b in combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        both = len(x & y)
        if x and y and 100 * both >= 85 * (len(x) + len(y) - both):
            root[top(b)] = top(a)
    least = defaultdict(list)
    for k, (i, s) in enumerate(sets):
        if i is not None:
            least[top(k)].append(i)
    wanted = [(i, len(s), min(least[top(k)], default=None) if s else i) for k, (i, s) in enumerate(sets)]
    assert Counter(map(tuple, signature_join.join(table, block=block).collect())) == Counter(wanted)
    assert max(Counter(c for *_, c in wanted).values()) > 40


def test_groups_leave_out_members_that_share_too_late(spark):
    rows = [(1, 14, "a", 100), (1, 14, "b", 100),     # 86 tokens are left of each, 92 are asked
            (2, 8, "a", 100), (2, 8, "b", 100),
            (3, 14, "a", 100), (3, 0, "c", 85),       # the shorter may lie in the longer one
            (4, 14, "a", 100), (4, 1, "c", 85),
            (5, 0, "a", 100), (5, 0, "d", 84),
            (6, 0, "a", 100), (6, 14, "b", 100), (6, 8, "e", 100), (6, 8, "e", 100),
            *[(7, 14, f"m{k}", 100) for k in range(signature_join.FEW + 1)]]
    tokens = spark.createDataFrame([(t << signature_join.PLACE_BITS | p, k.encode(), n) for t, p, k, n in rows], "token bigint, key binary, n bigint")
    found = defaultdict(set)
    for r in signature_join._groups(tokens, 85).collect():
        found[r["g"]].add((bytes(r["key"]).decode(), r["c"]))
    many = frozenset((f"m{k}", signature_join.FEW + 1) for k in range(signature_join.FEW + 1))
    assert set(map(frozenset, found.values())) == {frozenset({("a", 2), ("b", 2)}), frozenset({("a", 2), ("c", 2)}), frozenset({("a", 2), ("e", 2)}), many}


def test_jaccard_join_around_the_limit(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(60):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([12, 40, 150]))]
        for _ in range(5):
            lost, more = (rng.randrange(1 + len(base) // 7) for _ in range(2))
            texts.append(" ".join([*base[lost:], *(f"w{rng.randrange(4000)}" for _ in range(more))]))
    sets = [shingle_set(t) for t in texts]
    least = list(range(len(sets)))
    for a, b in combinations(range(len(sets)), 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
            old, new = max(least[a], least[b]), min(least[a], least[b])
            least = [new if x == old else x for x in least]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r["doc_id"]: r["component_id"] for r in signature_join.join(table).collect()} == dict(enumerate(least))
    assert 60 < len(set(least)) < 250


def test_trees_lose_no_link():
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(25):
        base = rng.integers(0, 1 << 63, size=rng.choice([20, 300, 700]), dtype=np.uint64)
        for _ in range(rng.integers(1, 30)):
            part = base[rng.random(len(base)) > rng.choice([0.0, 0.05, 0.12])]
            sets.append(np.unique(np.concatenate([part, rng.integers(0, 1 << 63, size=len(base) // 30, dtype=np.uint64)])))

    def rows(part):
        return pd.DataFrame({"key": [str(k).encode() for k in part], "n": [len(sets[k]) for k in part], "root": [str(k).encode() for k in part],
                             "signature": [signature_join.signature(sets[k]).tobytes() for k in part], "failed": [None for _ in part]})

    def connected(pairs):
        root = list(range(len(sets)))
        for a, b in pairs:
            old, new = root[b], root[a]
            root = [new if r == old else r for r in root]
        return root
    true = [(a, b) for a, b in combinations(range(len(sets)), 2)
            if 100 * (n := len(np.intersect1d(sets[a], sets[b]))) >= 85 * (len(sets[a]) + len(sets[b]) - n)]
    half = len(sets) // 2
    for proposals in (signature_join.forest(rows(range(len(sets))), None),
                      [p for part in (range(half), range(half, len(sets))) for p in signature_join.forest(rows(part), None)]
                      + signature_join.forest(rows(range(half)), rows(range(half, len(sets))))):
        root = connected([(int(a), int(b)) for a, b in proposals])
        assert all(root[a] == root[b] for a, b in true) and len(true) > 100


def test_jaccard_join_ships_hashed_keys_and_open_signatures(spark, monkeypatch):
    """Tokens carry 8 bytes of key; a round asks for the signatures of its rows alone."""
    words = [f"w{k}" for k in range(300)]
    # one base with copies that drop more and more: proposals fail, so that several rounds run
    texts = [" ".join(words[k:k + 200]) for k in range(0, 100, 4)] + [f"pair{k} " + " ".join(f"p{k}x{i}" for i in range(40)) + f" e{e}" for k in range(30) for e in (0, 1)]
    kinds, asked = [], []
    groups, small = signature_join._groups, signature_join._small

    def seen(tokens, percent):
        kinds.append(dict(tokens.dtypes)["key"])
        return groups(tokens, percent)

    def counted(df):
        if df.columns == ["key"]:
            asked.append(df.count())
        return small(df)

    monkeypatch.setattr(signature_join, "_groups", seen)
    monkeypatch.setattr(signature_join, "_small", counted)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: r["component_id"] for r in signature_join.join(table).collect()}
    assert found == {k: 0 if k < 25 else 25 + (k - 25) // 2 * 2 for k in range(len(texts))}
    assert kinds == ["bigint"]
    # the pairs are settled by their centres: no round asks for their signatures
    assert len(asked) > 1 and max(asked[1:]) <= 25 < asked[0]


def test_jaccard_join_deals_few_rows_in_few_tasks(spark):
    """With many shuffle partitions, the rounds of a small table stay a few tasks each."""
    words = [f"w{k}" for k in range(300)]
    texts = [" ".join(words[k:k + 200]) for k in range(0, 100, 4)] + [f"lone{k} " + " ".join(f"p{k}x{i}" for i in range(40)) for k in range(5)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    asked = {"spark.sql.shuffle.partitions": "97", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in asked}
    context.setJobGroup("few-tasks", "few rows")
    try:
        for k, v in asked.items():
            spark.conf.set(k, v)
        found = {r["doc_id"]: r["component_id"] for r in signature_join.join(table).collect()}
        stages = [s for j in tracker.getJobIdsForGroup("few-tasks") for s in tracker.getJobInfo(j).stageIds]
        ran = [i.numCompletedTasks for i in map(tracker.getStageInfo, stages) if i is not None]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
    assert found == {k: 0 if k < 25 else k for k in range(len(texts))}
    # before, some 8,000 tasks of as many stages
    assert sum(map(bool, ran)) > 50 and sum(ran) < 4000 and sum(n >= 97 for n in ran) < 25
