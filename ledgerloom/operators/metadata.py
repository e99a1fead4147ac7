"""Descriptions of data sets and what follows from them: keys that should be unique, slices, merged and matched texts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.aggregate import by_depth


@dataclass
class Dataset:
    """What is known of a table: its key, columns by which it may be sliced (from the top of a hierarchy down), columns by group."""

    key: list[str]
    slices: list[list[str]] = field(default_factory=list)
    groups: dict[str, list[str]] = field(default_factory=dict)
    date_format: str = "YYYYhqmm"

    def slice_sets(self) -> list[tuple[str, ...]]:
        """The prefixes of each hierarchy, () first, without repeats."""
        return list(dict.fromkeys(tuple(h[:i]) for h in self.slices for i in range(len(h) + 1)))

    def violations(self, df: DataFrame) -> DataFrame:
        """Keys that stand in more than one row, with their number of rows; nulls in a key are equal here."""
        return df.groupBy(*self.key).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")

    def counts(self, df: DataFrame, hierarchy: int = 0) -> DataFrame:
        """Rows for each slice of a hierarchy, from all rows to its full depth."""
        return by_depth(df, self.slices[hierarchy], F.count(F.lit(1)).alias("n_rows"))

    def select(self, df: DataFrame, *groups: str) -> DataFrame:
        """The columns of some groups."""
        return df.select(*(c for g in groups for c in self.groups[g]))


def merge_metadata(meta: DataFrame, by: Sequence[str], value: str, order: str, sep: str = ", ") -> DataFrame:
    """Values of several tables as one text for each key, distinct ones in order of appearance."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v"))))
    return meta.groupBy(*by).agg(F.array_join(F.array_distinct(F.transform(listed, lambda x: x["v"])), sep).alias(value))


def described_by_words(series: DataFrame, ident: str, title: str, descriptions: DataFrame, text: str, least: int = 2) -> DataFrame:
    """(ident, text, shared): the description with most words in common with a title, of those with at least `least`.

    Words meet by an equi-join on the word; ties go to the smallest text.
    """
    words = lambda df, keys, c: df.select(*keys, F.explode(F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}]{3,}"), F.lit(0)))).alias("word"))
    both = words(series, [ident], title).join(words(descriptions, [text], text), "word")
    shared = both.groupBy(ident, text).agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= least)
    best = shared.groupBy(ident).agg(F.max("shared").alias("shared")).join(shared, [ident, "shared"])
    return best.groupBy(ident, "shared").agg(F.min(text).alias(text)).select(ident, text, "shared")


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """df with comments in the metadata of its columns."""
    return df.select(*(F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c) for c in df.columns))
