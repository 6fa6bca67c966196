"""Expressions over attribute scores and scored spans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadwarden.schemas import ATTRIBUTES


def known(value: Column) -> Column:
    """NaN counts as missing."""
    return F.when(~F.isnan(value), value)


def row_max(columns: Sequence[str]) -> Column:
    """Largest of several columns, missing ones skipped."""
    values = [known(F.col(c)) for c in columns]
    return F.greatest(*values) if len(values) > 1 else values[0]


def winning_attribute(attributes: Sequence[str] = ATTRIBUTES) -> Column:
    """Struct (score, attribute, begin, end) of the highest score; the first attribute wins ties.

    Null when every score is missing.
    """
    entries = F.array(
        *[
            F.struct(
                known(F.col(f"{a}_score")).alias("score"),
                F.lit(-i).alias("before"),
                F.lit(a).alias("attribute"),
                F.col(f"{a}_max_span_begin").alias("begin"),
                F.col(f"{a}_max_span_end").alias("end"),
            )
            for i, a in enumerate(attributes)
        ]
    )
    return F.array_max(F.filter(entries, lambda e: e["score"].isNotNull()))


def best_span(spans: Column) -> Column:
    """Struct (score, before, begin, end) of the highest scored span; the first wins ties."""
    return F.array_max(
        F.transform(
            spans,
            lambda s, i: F.struct(
                s["score"]["value"].alias("score"), (-i).alias("before"), s["begin"].alias("begin"), s["end"].alias("end")
            ),
        )
    )
