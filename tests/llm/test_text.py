"""Tokens, mixing and shared spans."""

import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm.mixing import Plan, draw_shards, mix_documents, n_shards, pack, permuted, plan_mix, shares
from ledgerloom.llm.spans import gear, lowest, shared_share, shared_spans
from ledgerloom.llm.tokens import RANKS, Encoder, encoder, token_ids, token_text
from tests.conftest import rows


# ---- p8: encoding


def test_ids_equal_the_plain_encoding(spark, sf):
    from pyspark.sql import functions as F

    enc = encoder()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for r in docs.select("text", token_ids(F.col("text")).alias("ids")).collect():
        assert r["ids"] == (enc._encode(r["text"]) if r["text"] else [])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["the", " ", "  ", "\n", "\t", "'s", "'", "don't", ".", ",'re", "12", "a1", "é", "é", "語", "。", "Ω", " ", "　", "🙂", "‼️", "x" * 30, "'ll", "\r\n", "ß-"]), max_size=60).map("".join), st.integers(1, 12))
def test_tree_equals_plain_for_any_leaf(text, leaf):
    enc = _small(leaf)
    ids = enc.encode(text)
    assert ids == (enc._encode(text) if text else [])
    assert enc.decode(ids) == text


_encoders = {}


def _small(leaf):
    if leaf not in _encoders:
        _encoders[leaf] = Encoder(RANKS, leaf=leaf)
    return _encoders[leaf]


def test_long_texts_and_empty_ones(spark):
    from pyspark.sql import functions as F

    texts = [None, "", " ", "a" * 30_000, "語" * 5000, "word " * 20_000, "<|endoftext|>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in df.select("doc_id", token_ids(F.col("text")).alias("ids")).select("*", token_text(F.col("ids")).alias("back")).collect()}
    for i, t in enumerate(texts):
        assert got[i]["ids"] == (encoder()._encode(t) if t else [])
        assert got[i]["back"] == (t or "")
    assert 50256 not in got[6]["ids"]


def test_no_rows(spark):
    from pyspark.sql import functions as F

    assert spark.createDataFrame([], "doc_id long, text string").select(token_ids(F.col("text"))).collect() == []


# ---- p9: mixing


def test_permutations_are_permutations():
    for n in (1, 2, 3, 7, 64, 1000):
        for key in (0, 1, -5):
            got = permuted(np.arange(n), np.full(n, n), np.full(n, key, dtype=np.int64))
            assert sorted(got.tolist()) == list(range(n))


def test_mix_keeps_shares_and_limits(spark):
    rng = random.Random(1)
    docs = [(i, s, " ".join(rng.choice(["red", "blue", "green"]) for _ in range(rng.randint(1, 60)))) for i, s in enumerate(["a"] * 200 + ["b"] * 40 + ["c"] * 10 + ["x"] * 10)]
    docs += [(900, "a", None), (901, "b", ""), (902, None, "red"), (903, " A ", "red")]
    docs = spark.createDataFrame(docs, "doc_id long, source string, text string").withColumn("shard", docs_extra())
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.1, 4), ("none", 0.1, 3)], "source string, target_share double, max_repeats int")
    mixed, plan, blocks = mix_documents(docs, targets, block=16)
    used = mixed.collect()
    report = {r["source"]: r for r in shares(spark, mixed, plan).collect()}
    assert report["none"]["used"] == 0 and "x" not in report
    for s, share in (("a", 0.5), ("b", 0.3), ("c", 0.1)):
        assert abs(report[s]["share"] - share / 0.9) < 0.02
        assert report[s]["most_uses"] <= plan.targets[s][1]
    assert len({(r["source"], r["block"], r["use"]) for r in used}) == len(used)
    assert len({(r["shard"], r["pos"]) for r in used}) == len(used)
    assert max(max(r["n"] for r in used), 0) <= 16
    # all texts of a source stand in its blocks, each token once
    tokens = defaultdict(int)
    for r in blocks.collect():
        tokens[r["source"]] += r["n"]
        assert r["n"] == len(r["ids"])
    enc = encoder()
    assert tokens["a"] == sum(len(enc.encode(r["text"])) for r in docs.collect() if (r["source"] or "").strip().lower() == "a")


def docs_extra():
    from pyspark.sql import functions as F

    return F.lit("an extra column")


def test_a_given_size_uses_small_sources_in_full(spark):
    docs = spark.createDataFrame([(i, "big", "one two three four") for i in range(400)] + [(1000 + i, "small", "five six seven eight") for i in range(10)], "doc_id long, source string, text string")
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 2)], "source string, target_share double, max_repeats int")
    mixed, plan, blocks = mix_documents(docs, targets, block=4, total_blocks=300)
    have = {s: n for s, (n, _, _) in plan.sources.items()}
    assert plan.sources["small"][2] == 2 * have["small"]
    assert sum(t for *_x, t in plan.sources.values()) == 300
    uses = defaultdict(int)
    for r in mixed.collect():
        uses[r["source"], r["block"]] += 1
    assert max(uses.values()) == 2 and {uses[k] for k in uses if k[0] == "small"} == {2}


def test_mix_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    mixed, plan, _ = mix_documents(docs, targets)
    assert mixed.collect() == []
    assert rows(shares(spark, mixed, plan), "source", "used", "share") == [("a", 0, 0.0)]


def test_shards_draw_each_slot_once(spark):
    ids = spark.createDataFrame([(s, i, list(range(5))) for s in "ab" for i in range(1500)], "source string, doc_id long, ids array<int>")
    blocks = pack(ids, 5, 3, rows_per_bucket=100)
    plan = plan_mix(blocks, {"a": (0.5, 1), "b": (0.5, 1)}, 5, 3)
    drawn = list(draw_shards(plan))
    assert sum(k for *_x, k in drawn) == 3000
    # any range of shards is drawn alike on its own, and shards have the same size but for the last
    assert [x for i in range(n_shards(plan)) for x in draw_shards(plan, i, i + 1)] == drawn and list(draw_shards(plan, 1, 3)) == [x for x in drawn if x[0] > 0]
    assert [sum(k for i, *_x, k in drawn if i == j) for j in range(3)] == [1024, 1024, 952]
    huge = Plan(256, 7, {}, {"a": (10**9, 0, 9 * 10**11), "b": (10**9, 0, 10**11)})
    some = list(draw_shards(huge, 500_000_000, 500_000_003))
    assert [sum(k for i, *_x, k in some if i == j) for j in range(500_000_000, 500_000_003)] == [1024] * 3
    seen = {s: [] for s in "ab"}
    for _, s, first, k in drawn:
        seen[s] += range(first, first + k)
    assert seen["a"] == list(range(1500)) == seen["b"]


# ---- p10: shared spans


def brute(texts, n):
    where = defaultdict(set)
    for d, t in texts.items():
        for i in range(len(t) - n + 1):
            where[t[i : i + n]].add(d)
    out = []
    for d, t in texts.items():
        end = None
        for i in range(len(t) - n + 1):
            if len(where[t[i : i + n]]) > 1:
                if end is not None and i <= end:
                    out[-1] = (d, out[-1][1], i + n)
                else:
                    out.append((d, i, i + n))
                end = i + n
    return sorted(out, key=str)


def spans(spark, texts, n=160):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").selectExpr("*", "1 as lo", "2 as d1", "'x' as cut")
    return rows(shared_spans(df, n), "doc_id", "span_start", "span_end")


def test_spans_against_all_spans(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if r["text"]}
    assert spans(spark, texts) == brute(texts, 160)


@pytest.mark.parametrize("seed", range(3))
def test_spans_of_copied_pieces(spark, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé語🙂 ") for _ in range(rng.randint(1, 9)))
    texts = {d: " ".join(word() for _ in range(rng.randint(0, 150))) for d in range(30)}
    for _ in range(40):
        a, b = rng.sample(range(30), 2)
        i, k = rng.randint(0, len(texts[a])), rng.randint(150, 400)
        j = rng.randint(0, len(texts[b]))
        texts[b] = texts[b][:j] + texts[a][i : i + k] + texts[b][j:]
    texts |= {100: "z" * 500, 101: "z" * 170, 102: "ab" * 200, 103: "q" * 159, 104: "q" * 159, 105: "w" * 400}
    assert spans(spark, texts) == brute(texts, 160)


def test_spans_of_nothing(spark):
    assert spans(spark, {1: "short", 2: "short"}) == []
    df = spark.createDataFrame([(1, None), (2, ""), (None, "x" * 300)], "doc_id long, text string")
    assert rows(shared_spans(df)) == []
    assert rows(shared_spans(df.limit(0))) == []
    assert rows(shared_share(df.where("doc_id is not null"), shared_spans(df)), "doc_id", "shared", "share") == [(1, 0, None), (2, 0, None)]


def test_boilerplate_in_a_third_of_the_texts(spark):
    rng = random.Random(5)
    fill = lambda: "".join(rng.choice("abcdefgh ") for _ in range(200))
    plate = fill() + fill()
    texts = {d: fill() + (plate if d % 3 == 0 else "") + fill() for d in range(90)}
    got = spans(spark, texts)
    assert got == brute(texts, 160)
    assert len(got) == 30


def test_lowest_is_the_first_smallest():
    h = gear(np.frombuffer("".join(random.Random(2).choice("abc") for _ in range(500)).encode("utf-32-le"), dtype=np.uint32))
    for w in (1, 2, 5, 97):
        assert lowest(h, w).tolist() == [i + int(np.argmin(h[i : i + w])) for i in range(len(h) - w + 1)]
