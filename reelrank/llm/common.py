"""Helpers shared by the training-data operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The blank characters that separate words, as a regular expression class.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body`` any number of times.

    An array expression used inside a lambda would be evaluated again for every element;
    bound as a lambda variable it is evaluated once per row.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text) -> Column:
    """The maximal runs of non-blank characters, in order (null text: empty array)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS, -1), "")


def ascii_lower(text) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns that an operator is about to produce (its output replaces them)."""
    taken = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


class Shelved:
    """A table under names of its own (u0, u1, …), so that no helper column can meet a user's.

    ``table`` is the renamed table, ``at`` finds a column's new name, ``finish`` gives all
    columns under their old names, but those that the outputs replace, and the outputs.
    """

    def __init__(self, df: DataFrame):
        self.names = df.columns
        self.table = df.toDF(*[f"u{i}" for i in range(len(self.names))])

    def at(self, name: str) -> str:
        same = [i for i, n in enumerate(self.names) if n == name] or \
            [i for i, n in enumerate(self.names) if n.lower() == name.lower()]
        if not same:
            raise ValueError(f"no column {name}")
        return f"u{same[0]}"

    def finish(self, df: DataFrame, **outputs: Column) -> DataFrame:
        kept = [i for i, n in enumerate(self.names) if n.lower() not in outputs]
        # Renamed by place in a step of its own: an alias could shadow a helper column.
        return df.select(*[F.col(f"u{i}") for i in kept],
                         *[c.alias(f"o{i}") for i, c in enumerate(outputs.values())]
                         ).toDF(*[self.names[i] for i in kept], *outputs)
