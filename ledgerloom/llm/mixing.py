"""Mixing of sources to target shares of tokens."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.tokens import RANKS, token_ids
from ledgerloom.session import cut

#: Blocks of an output shard; the last may have fewer.
SHARD = 1024


@dataclass
class Plan:
    """How many blocks of each source the mix takes: source -> (blocks there are, tokens there are, blocks taken)."""

    block: int
    seed: int
    targets: dict[str, tuple[float, int]]
    sources: dict[str, tuple[int, int, int]]


def pack(docs: DataFrame, block: int, seed: int, rows_per_bucket: int = 20_000) -> DataFrame:
    """Fixed-length blocks of each source: docs (source, doc_id, ids) -> (source, block, n, ids).

    Texts of a source stand in a pseudorandom order, their tokens form one sequence, and block i holds its tokens
    i * block and following; only a source's last block may be shorter. Positions come from a prefix sum in two levels:
    over the totals of hash buckets, then inside each bucket, so no source, however large, is summed by one task.
    """
    n = F.size("ids").cast("long")
    docs = docs.where(F.size("ids") > 0).withColumn("h", F.xxhash64("doc_id", F.lit(seed)))
    buckets = max(16, math.ceil(docs.count() / rows_per_bucket))
    docs = docs.withColumn("bucket", F.pmod(F.col("h"), F.lit(buckets)))
    totals = docs.groupBy("source", "bucket").agg(F.sum(n).alias("tokens"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("source", "bucket", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long")).alias("base"))
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = docs.withColumn("inner", F.coalesce(F.sum(n).over(inside), F.lit(0).cast("long"))).join(bases, ["source", "bucket"])
    placed = placed.select("source", "ids", (F.col("base") + F.col("inner")).alias("start"), n.alias("n"))
    pieces = placed.select("*", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("n") - 1) / block))).alias("block"))
    lo = F.greatest(F.col("block") * block - F.col("start"), F.lit(0))
    hi = F.least((F.col("block") + 1) * block - F.col("start"), F.col("n"))
    pieces = pieces.select("source", "block", (F.col("start") + lo).alias("at"), F.slice("ids", (lo + 1).cast("int"), (hi - lo).cast("int")).alias("ids"))
    blocks = pieces.groupBy("source", "block").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "ids"))), lambda p: p["ids"])).alias("ids"))
    return blocks.select("source", "block", F.size("ids").alias("n"), "ids")


def plan_mix(blocks: DataFrame, targets: dict[str, tuple[float, int]], block: int, seed: int, total_blocks: int | None = None) -> Plan:
    """Blocks to take of each source.

    Sources without texts are left out and the others' shares scaled to sum to 1. Without total_blocks the mix is the
    largest in which every share is exact to a block within the limits of repeats. With it, a source that can't give
    its share gives all it may, and the rest is shared out among the others in proportion, as far as they reach.
    """
    have = {r["source"]: (r["blocks"], r["tokens"]) for r in blocks.groupBy("source").agg(F.count(F.lit(1)).alias("blocks"), F.sum("n").alias("tokens")).collect()}
    usable = {s: (share, reps) for s, (share, reps) in targets.items() if s in have and share > 0 and reps > 0}
    taken = dict.fromkeys(usable, 0)
    caps = {s: have[s][0] * reps for s, (_, reps) in usable.items()}
    if usable:
        whole = sum(share for share, _ in usable.values())
        rest = total_blocks if total_blocks is not None else math.floor(min(caps[s] * whole / share for s, (share, _) in usable.items()))
        left = dict(usable)
        while left and rest > 0:
            scale = rest / sum(share for share, _ in left.values())
            full = [s for s, (share, _) in left.items() if share * scale >= caps[s]]
            for s in full or left:
                taken[s] = caps[s] if full else min(caps[s], round(left[s][0] * scale))
                rest -= taken[s]
            left = {s: x for s, x in left.items() if s not in full} if full else {}
    return Plan(block, seed, targets, {s: (*have[s], taken.get(s, 0)) for s in have})


def n_shards(plan: Plan) -> int:
    return -(-sum(taken for _, _, taken in plan.sources.values()) // SHARD)


def draw_shards(plan: Plan, lo: int = 0, hi: int | None = None) -> Iterator[tuple[int, str, int, int]]:
    """(shard, source, first slot of the source, slots) of the shards lo to hi (exclusive; all by default), by multinomial draws.

    The draws form a tree: the blocks of all shards are divided between two halves of the shards by a multinomial draw
    from what there is of each source, and so on down to single shards. Each node has a seed of its own, so any range of
    shards is drawn anywhere, alone and alike, in time that goes with its length.
    """
    names = sorted(s for s, (_, _, taken) in plan.sources.items() if taken)
    left = np.array([plan.sources[s][2] for s in names], dtype=np.int64)
    hi = n_shards(plan) if hi is None else hi

    def draw(a: int, b: int, left: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, str, int, int]]:
        if b <= lo or a >= hi:
            return
        if b - a == 1:
            yield from ((a, s, int(f), int(k)) for s, f, k in zip(names, first, left, strict=True) if k)
            return
        mid, drawn = (a + b) // 2, np.zeros(len(names), dtype=np.int64)
        rng = np.random.default_rng([plan.seed, a, b])
        while (missing := (mid - a) * SHARD - int(drawn.sum())) > 0:
            free = left - drawn
            drawn = np.minimum(left, drawn + rng.multinomial(missing, free / free.sum()))
        yield from draw(a, mid, drawn, first)
        yield from draw(mid, b, left - drawn, first + drawn)

    if names:
        yield from draw(0, n_shards(plan), left, np.zeros(len(names), dtype=np.int64))


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of range(size), chosen by key, at index: a Feistel network with cycle walking."""
    index, size, key = index.astype(np.uint64), size.astype(np.uint64), key.astype(np.uint64)
    half = np.ceil(np.log2(np.maximum(size, 2).astype(np.float64) + 1) / 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)

    def once(x: np.ndarray) -> np.ndarray:
        a, b = x >> half, x & mask
        for r in range(4):
            f = (b + key + np.uint64(0x9E3779B97F4A7C15) * np.uint64(r + 1)) * np.uint64(0xBF58476D1CE4E5B9)
            f ^= f >> np.uint64(29)
            f *= np.uint64(0x94D049BB133111EB)
            a, b = b, a ^ ((f >> np.uint64(32)) & mask)
        return (a << half) | b

    with np.errstate(over="ignore"):
        x = once(index)
        while (out := x >= size).any():
            x = np.where(out, once(x), x)
    return x.astype(np.int64)


def mix(spark: SparkSession, blocks: DataFrame, plan: Plan) -> DataFrame:
    """The mix: (shard, pos, source, block, use, n, ids), where use counts a block's uses from 1.

    Slots of the shards are mapped through a permutation for each source and use to block numbers and joined to the
    blocks by number. Numbers are uniform, so the join has no hot key however large a source is.
    """

    def drawn_here(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:  # shards of a batch follow one another
            rows = [(shard, s, f, k, plan.sources[s][0]) for shard, s, f, k in draw_shards(plan, int(b["id"].min()), int(b["id"].max()) + 1)] if len(b) else []
            yield pd.DataFrame(rows, columns=["shard", "source", "first", "slots", "size"])

    drawn = spark.range(n_shards(plan)).mapInPandas(drawn_here, "shard long, source string, first long, slots long, size long")

    @F.pandas_udf("long")
    def number(index: pd.Series, size: pd.Series, key: pd.Series) -> pd.Series:
        return pd.Series(permuted(index.to_numpy(), size.to_numpy(), key.to_numpy()))

    slots = drawn.select("shard", "source", "size", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("slots") - 1)).alias("slot"))
    use = F.floor(F.col("slot") / F.col("size"))
    slots = slots.select("shard", "source", "slot", (use + 1).cast("int").alias("use"), number(F.col("slot") % F.col("size"), F.col("size"), F.xxhash64("source", use, F.lit(plan.seed))).alias("block"))
    order = Window.partitionBy("shard").orderBy(F.xxhash64("source", "slot", F.lit(plan.seed)), "source", "slot")
    slots = slots.withColumn("pos", F.row_number().over(order))
    return slots.join(blocks, ["source", "block"]).select("shard", "pos", "source", "block", "use", "n", "ids")


def shares(spark: SparkSession, mixed: DataFrame, plan: Plan) -> DataFrame:
    """Per source of the targets or the texts: target_share, max_repeats, tokens there are, tokens used, share, most uses of a text."""
    rows = [(s, *plan.targets.get(s, (None, None)), plan.sources.get(s, (0, 0, 0))[1]) for s in sorted({*plan.targets, *plan.sources})]
    known = spark.createDataFrame(rows, "source string, target_share double, max_repeats int, tokens long")
    used = mixed.groupBy("source").agg(F.sum("n").alias("used"), F.max("use").alias("most_uses"))
    total = Window.partitionBy()  # over one row for each source
    out = known.join(F.broadcast(used), "source", "left").fillna(0, ["used", "most_uses"])
    return out.withColumn("share", F.coalesce(F.try_divide("used", F.sum("used").over(total)), F.lit(0.0)))


def mix_documents(docs: DataFrame, targets: DataFrame, block: int = 256, seed: int = 7, total_blocks: int | None = None, ranks: str = RANKS) -> tuple[DataFrame, Plan, DataFrame]:
    """Mix docs (doc_id, source, text) by targets (source, target_share, max_repeats): (mix, plan, blocks).

    Sources are compared without case and surrounding blanks; texts of null or other sources, null and empty texts are
    left out. A repeated target row adds its share and takes the larger limit; null shares and limits count as 0.
    Targets are a list of sources a person wrote, so they and their totals (a row for each) are the driver's to hold.
    """
    name = F.lower(F.trim("source"))
    wanted = targets.where(F.col("source").isNotNull()).groupBy(name.alias("source")).agg(F.sum("target_share").alias("share"), F.max("max_repeats").alias("reps")).collect()
    goal = {r["source"]: (float(r["share"] or 0), int(r["reps"] or 0)) for r in wanted}
    chosen = docs.where(name.isin(list(goal))).select(name.alias("source"), "doc_id", token_ids(F.col("text"), ranks).alias("ids"))
    blocks = cut(pack(cut(chosen), block, seed))
    plan = plan_mix(blocks, goal, block, seed, total_blocks)
    return mix(docs.sparkSession, blocks, plan), plan, blocks
