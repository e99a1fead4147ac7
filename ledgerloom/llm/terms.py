"""Frequencies of terms by a range-partitioned external sort and run-length scanning."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normal_word(c: Column) -> Column:
    """Upper case with only letters and digits (Unicode L and N) kept."""
    return F.regexp_replace(F.upper(c), r"[^\p{L}\p{N}]+", "")


KEYS = ("term", "record", "item")
SUMS = ("occurrences", "weight")


def _changes(table: pa.Table, columns: tuple[str, ...]) -> np.ndarray:
    """Whether each row differs from the row before in any of the columns; the first row does."""
    out = np.zeros(table.num_rows, dtype=bool)
    out[:1] = True
    for c in columns:
        x = table[c].combine_chunks()
        out[1:] |= pc.not_equal(x.slice(1), x.slice(0, len(x) - 1)).to_numpy(zero_copy_only=False)
    return out


def _runs(batches: Iterator[pa.RecordBatch], tallies: bool) -> Iterator[pa.RecordBatch]:
    """Scan sorted (term, record, item, occurrences, weight) rows and give the totals of each run of a term.

    With tallies, rows equal in term, record and item are one tally stored repeatedly: the largest counts. A record is
    counted once in its run. What a batch leaves open (the last tally, the last record, the last run) is carried to the
    next as one row each, so memory is one batch however long the run.
    """
    schema = pa.schema([("term", pa.string()), ("occurrences", pa.int64()), ("weight", pa.int64()), ("records", pa.int64())])
    held = last = run = None  # the tally, (term, record) and totals that aren't over
    for batch in chain(batches, [None]):
        if batch is not None:
            table = pa.table({c: batch.column(c) for c in (*KEYS, *SUMS)})
            if held is not None:
                table = pa.concat_tables([held, table])
            if not table.num_rows:
                continue
            if tallies:
                at = np.flatnonzero(_changes(table, KEYS))
                largest = {c: np.maximum.reduceat(table[c].to_numpy(), at) for c in SUMS}
                table = pa.table({c: table[c].take(at).combine_chunks() for c in KEYS} | {c: pa.array(x) for c, x in largest.items()})
                held, table = table.slice(table.num_rows - 1), table.slice(0, table.num_rows - 1)
        else:
            table = held
        if table is None or not table.num_rows:
            continue
        fresh = _changes(table, KEYS[:2])
        fresh[0] = last != (table["term"][0].as_py(), table["record"][0].as_py())
        at = np.flatnonzero(_changes(table, KEYS[:1]))
        sums = [np.add.reduceat(x, at).tolist() for x in (*(table[c].to_numpy() for c in SUMS), fresh.astype(np.int64))]
        rows = list(zip(table["term"].take(at).to_pylist(), *sums, strict=True))
        if run and rows[0][0] == run[0]:
            rows[0] = (run[0], *(x + y for x, y in zip(run[1:], rows[0][1:], strict=True)))
        elif run:
            rows.insert(0, run)
        last, run = (table["term"][-1].as_py(), table["record"][-1].as_py()), rows.pop()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    if run:
        yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(run, schema, strict=True)], schema=schema)


def term_frequencies(
    rows: DataFrame, term: str, record: str, occurrences: Column | None = None, weight: Column | None = None, item: str | None = None, partitions: int | None = None
) -> DataFrame:
    """How often every term occurs and in how many records: term, occurrences, weight, records.

    rows has one row for each occurrence, or for each tally of occurrences; weight (0 if not given) is summed beside.
    With `item`, rows equal in term, record and item are one tally that was stored repeatedly: its largest values count
    once. Rows with a null term are left out; a null record counts as one record of its own; nulls in tallies count as 0.

    Pairs (term, record) are range-partitioned by both as they come, sorted (the sort spills to disk as needed) and
    scanned: all counting is done by the run-length scan. As the ranges divide by record within a term, a term of a third
    of all pairs is spread over a third of the partitions, and equal pairs still meet; each partition gives one row per
    term, and a small last sum joins the runs that go on in the next partition.
    """
    one, zero, none = F.lit(1).cast("long"), F.lit(0).cast("long"), F.lit("")
    pairs = rows.where(F.col(term).isNotNull()).select(
        F.col(term).alias("term"),
        F.coalesce(F.concat(F.lit("="), F.col(record).cast("string")), none).alias("record"),
        (F.coalesce(F.concat(F.lit("="), F.col(item).cast("string")), none) if item else none).alias("item"),
        (F.coalesce(occurrences.cast("long"), zero) if occurrences is not None else one).alias("occurrences"),
        (F.coalesce(weight.cast("long"), zero) if weight is not None else zero).alias("weight"),
    )
    ranged = pairs.repartitionByRange(partitions, *KEYS[:2]) if partitions else pairs.repartitionByRange(*KEYS[:2])
    runs = ranged.sortWithinPartitions(*KEYS[: 3 if item else 2]).mapInArrow(lambda b: _runs(b, item is not None), "term string, occurrences long, weight long, records long")
    return runs.groupBy("term").agg(F.sum("occurrences").alias("occurrences"), F.sum("weight").alias("weight"), F.sum("records").alias("records"))


def mark_terms(freq: DataFrame, rare_at_most: int, common_over: Column) -> DataFrame:
    """Add mark: `rare` for at most rare_at_most occurrences, `common` where weight or records exceed what common_over says, both if both hold."""
    mark = F.array_compact(F.array(F.when(F.col("occurrences") <= rare_at_most, "rare"), F.when(common_over, "common")))
    return freq.withColumn("marks", mark)
