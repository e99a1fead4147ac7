"""Long exact spans shared between texts, by content-defined chunks of a gear rolling hash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.skew import lookup_join
from ledgerloom.session import cut

#: Characters of the gear hash: a 64-bit gear hash forgets what is 64 characters back.
GEAR = 64
#: Code points handled at once in a worker.
BLOCK = 1_000_000
CHUNKS = pa.schema([("doc_id", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("cut", pa.int64()), ("d", pa.int64())])
GRAMS = pa.schema([("cut", pa.int64()), ("g", pa.int64()), ("d", pa.int64()), ("off", pa.int32()), ("first", pa.int64()), ("last", pa.int64())])


def gear(codes: np.ndarray) -> np.ndarray:
    """Gear hash of codes[i : i + GEAR] for each i: every step back shifts a character's random number by one bit.

    The rolling sum is formed by doubling (2, 4, ... 64 characters), and mixed once so that its order is random.
    """
    with np.errstate(over="ignore"):
        h = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        m = 1
        while m < GEAR:
            h = (h[:-m] << np.uint64(m)) + h[m:]
            m *= 2
        h *= np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def lowest(h: np.ndarray, window: int) -> np.ndarray:
    """Index of the first smallest value of h[i : i + window] for each i."""
    at, m = np.arange(len(h)), 1
    while m < window:
        step = min(m, window - m)
        a, b = at[:-step], at[step:]
        at = np.where(h[b] < h[a], b, a)
        m += step
    return at


def _digests(data: np.ndarray, spans: Iterator[tuple[int, int]]) -> np.ndarray:
    """64-bit digests of codes data[a:b]; with the cut's own hash, by which they are always kept, that makes 128 bits."""
    from xxhash import xxh3_64_intdigest

    view = memoryview(data).cast("B")
    return np.array([xxh3_64_intdigest(view[4 * a : 4 * b]) for a, b in spans], dtype=np.uint64).view(np.int64)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _chunks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Chunks (doc_id, lo, hi, cut, d) of (doc_id, text) rows; see shared_spans."""
    window = length - GEAR + 1

    def some(ids: list[int], texts: list[str]) -> pa.RecordBatch:
        sizes = np.array([len(t) for t in texts])
        codes = _codes("".join(texts))
        h = gear(codes)
        at = lowest(h, window)  # for each span of `length` characters, the place of its own cut
        ends = np.cumsum(sizes)
        doc = np.repeat(np.arange(len(texts)), sizes)[: len(at)]
        starts = np.flatnonzero(np.arange(len(at)) + length <= ends[doc])  # spans inside one text
        if not len(starts):
            return pa.RecordBatch.from_pylist([], CHUNKS)
        d, cut_at = doc[starts], at[starts]
        new = np.flatnonzero(np.r_[True, (cut_at[1:] != cut_at[:-1]) | (d[1:] != d[:-1])])
        lo, hi = starts[new], starts[np.r_[new[1:] - 1, len(starts) - 1]]
        base = (ends - sizes)[d[new]]
        dig = _digests(codes, zip(lo.tolist(), (hi + length).tolist(), strict=True))
        cols = [np.asarray(ids)[d[new]], (lo - base).astype(np.int32), (hi - base).astype(np.int32), h[cut_at[new]].view(np.int64), dig]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, CHUNKS, strict=True)], schema=CHUNKS)

    ids, texts, held = [], [], 0
    for batch in batches:
        for i, t in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            if len(t) < length:
                continue
            ids.append(i)
            texts.append(t)
            held += len(t)
            if held >= BLOCK:
                yield some(ids, texts)
                ids, texts, held = [], [], 0
    if texts:
        yield some(ids, texts)


def _grams(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Digest of each span of `length` characters in the chunks listed beside a text."""
    for batch in batches:
        for text, chunks in zip(batch["text"], batch["chunks"], strict=True):
            codes = _codes(text.as_py())
            rows = [(c["lo"], c["hi"], c["cut"], c["d"], c["first"], c["last"]) for c in chunks.as_py()]
            for k in range(0, len(rows), 2000):
                part = rows[k : k + 2000]
                n = np.array([hi - lo + 1 for lo, hi, *_ in part])
                dig = _digests(codes, ((s, s + length) for lo, hi, *_ in part for s in range(lo, hi + 1)))
                off = np.concatenate([np.arange(x) for x in n]).astype(np.int32)
                rep = lambda j: np.repeat(np.array([r[j] for r in part], dtype=np.int64), n)  # noqa: B023, E731
                cols = [rep(2), dig, rep(3), off, rep(4), rep(5)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, GRAMS, strict=True)], schema=GRAMS)


def shared_spans(docs: DataFrame, length: int = 160) -> DataFrame:
    """Longest stretches of each text all of whose characters lie in spans of `length` or more found in another text.

    docs has doc_id (long, unique) and text; returns doc_id, span_start, span_end (code points from 0, end exclusive).
    Null texts and texts under `length` have none; what repeats only within its own text doesn't count; extra columns
    are left alone; empty input gives no rows. length is at least 65.

    Method: each span of `length` characters is cut at the smallest gear hash (of 64 characters) inside it, so equal
    spans are cut alike wherever they stand and whatever was inserted before. Neighbouring spans with the same cut make
    a chunk of variable size; a text has about one for each (length - 64) / 2 characters, and any shared span belongs
    to chunks with the same cut hash. Chunks are deduplicated by 128 bits (hash of
    the cut, digest of the text): one found in two texts is shared as
    a whole. Where a cut is found in several texts but some chunk around it in one only (the ends of copied stretches),
    each distinct chunk is looked into once: the digests of its spans meet those of the other distinct chunks with that
    cut, and its first and last shared span bound what it shares (all its spans overlap). No pairs are formed: a chunk
    knows its smallest and largest doc_id, and two different ones say that another text has it. Boilerplate of a third
    of all texts is one chunk after the partial aggregation, and lookups of hot digests go by broadcast.
    """
    if length <= GEAR:
        raise ValueError(f"length is more than {GEAR}")
    texts = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull() & (F.length("text") >= length))
    schema = "doc_id long, lo int, hi int, cut long, d long"
    chunks = cut(texts.mapInArrow(lambda b: _chunks(b, length), schema))
    distinct = cut(
        chunks.groupBy("cut", "d").agg(F.min(F.struct("doc_id", "lo", "hi")).alias("one"), F.max("doc_id").alias("last"))
        .select("cut", "d", F.col("one.doc_id").alias("first"), "last", F.col("one.lo").alias("lo"), F.col("one.hi").alias("hi"))
    )
    cuts = distinct.groupBy("cut").agg(F.min("first").alias("a"), F.max("last").alias("b"), F.count(F.lit(1)).alias("n"), F.bool_or(F.col("first") == F.col("last")).alias("open"))
    look = lookup_join(distinct, cuts.where("a <> b AND n > 1 AND open").select("cut"), "cut", "inner")
    beside = look.groupBy(F.col("first").alias("doc_id")).agg(F.collect_list(F.struct("lo", "hi", "cut", "d", "first", "last")).alias("chunks"))
    grams = cut(
        beside.join(texts, "doc_id").select("text", "chunks").mapInArrow(lambda b: _grams(b, length), "cut long, g long, d long, off int, first long, last long")
    )
    both = grams.groupBy("cut", "g").agg(F.min("first").alias("a"), F.max("last").alias("b")).where("a <> b").select("cut", "g")
    parts = lookup_join(grams, both, ["cut", "g"], "inner").groupBy("cut", "d").agg(F.min("off").alias("from"), F.max("off").alias("to"))
    whole = distinct.where(F.col("first") != F.col("last")).select("cut", "d", F.lit(0).alias("from"), (F.col("hi") - F.col("lo")).alias("to"))
    known = cut(whole.unionByName(parts).groupBy("cut", "d").agg(F.min("from").alias("from"), F.max("to").alias("to")))
    hits = lookup_join(chunks, known, ["cut", "d"], "inner").select("doc_id", (F.col("lo") + F.col("from")).alias("a"), (F.col("lo") + F.col("to") + length).alias("b"))
    order = Window.partitionBy("doc_id").orderBy("a", "b")
    so_far = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = hits.withColumn("new", F.when(F.col("a") <= so_far, 0).otherwise(1)).withColumn("k", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return fresh.groupBy("doc_id", "k").agg(F.min("a").alias("span_start"), F.max("b").alias("span_end")).select("doc_id", "span_start", "span_end")


def shared_share(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Per text: doc_id, n_chars, shared (characters in shared stretches), share of the text; 0 where nothing is shared, share null for null and empty texts."""
    sums = spans.groupBy("doc_id").agg(F.sum(F.col("span_end") - F.col("span_start")).alias("shared"))
    out = docs.select("doc_id", F.length("text").alias("n_chars")).join(sums, "doc_id", "left").fillna(0, ["shared"])
    return out.withColumn("share", F.try_divide("shared", "n_chars"))
