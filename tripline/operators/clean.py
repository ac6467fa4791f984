"""Cleaning rules, per-rule reject profile and exact-duplicate removal."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tripline.model import TripModel


def duration_seconds(model: TripModel) -> Column:
    return F.unix_timestamp(F.col(model.end)) - F.unix_timestamp(F.col(model.start))


class Rule(NamedTuple):
    """``keep`` is TRUE for rows that pass; ``inputs`` are the columns it reads."""

    name: str
    keep: Column
    inputs: tuple[str, ...]


def rules(df: DataFrame, model: TripModel) -> list[Rule]:
    """The cleaning contract: a row is kept when every rule is TRUE; NULL
    counts as a reject."""
    lo, hi = model.zone_range
    start, end = F.col(model.start), F.col(model.end)

    def positive(name: str, upper: float | None = None) -> Column:
        # NULL > 0 is NULL, which rejects the row: no separate IS NOT NULL
        # (it would evaluate a computed column once more per row).  NaN sorts
        # above every number, so the upper bound rejects it too.
        if upper is not None:
            return (F.col(name) > 0) & (F.col(name) <= upper)
        if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
            return (F.col(name) > 0) & (F.col(name) < float("inf"))
        return F.col(name) > 0

    both = (model.start, model.end)
    out = [
        Rule("start_present", start.isNotNull(), (model.start,)),
        Rule("end_present", end.isNotNull(), (model.end,)),
        Rule("order", end > start, both),
        Rule("duration", duration_seconds(model) <= model.max_duration_s, both),
        Rule("party", positive(model.party), (model.party,)),
        Rule("distance", positive(model.distance, model.max_distance), (model.distance,)),
        Rule("fare", positive(model.fare, model.max_fare), (model.fare,)),
        Rule("total", positive(model.total), (model.total,)),
        Rule("origin", F.col(model.origin).between(lo, hi), (model.origin,)),
        Rule("destination", F.col(model.dest).between(lo, hi), (model.dest,)),
    ]
    if model.year is not None:
        # a range instead of year(start), so that the scan gets the filter
        kind = df.schema[model.start].dataType
        first, after = (F.lit(f"{y:04d}-01-01").cast(kind) for y in (model.year, model.year + 1))
        out.append(Rule("year", (start >= first) & (start < after), (model.start,)))
    return out


def _keep_all(df: DataFrame, model: TripModel) -> Column:
    return reduce(lambda a, b: a & b, [r.keep for r in rules(df, model)])


def clean(df: DataFrame, model: TripModel) -> DataFrame:
    """One filter; Catalyst splits it and pushes single-table conjuncts into
    the scans (and below joins)."""
    return df.filter(_keep_all(df, model))


def reject_profile(df: DataFrame, model: TripModel) -> DataFrame:
    """Rows in, rows rejected by each rule and by any rule, in one pass:
    ``(rule, rejected, missing)``; ``missing`` counts the rows where an input
    of the rule is NULL, so the rest of ``rejected`` are bad values."""
    found = rules(df, model)

    def missing(names: Iterable[str]) -> Column:
        return reduce(lambda a, b: a | b, [F.col(n).isNull() for n in sorted(set(names))])

    rows = [("rows_in", F.count(F.lit(1)), F.lit(0).cast("bigint"))]
    for r in found:
        failed = ~F.coalesce(r.keep, F.lit(False))
        rows.append((r.name, F.count_if(failed), F.count_if(missing(r.inputs))))
    failed = ~F.coalesce(_keep_all(df, model), F.lit(False))
    every = missing(n for r in found for n in r.inputs)
    rows.append(("any_rule", F.count_if(failed), F.count_if(every)))
    counts = df.agg(F.array(*[
        F.struct(F.lit(name).alias("rule"), rejected.alias("rejected"), null.alias("missing"))
        for name, rejected, null in rows
    ]).alias("rows"))
    return counts.select(F.inline("rows"))


def raw_counts(df: DataFrame, model: TripModel) -> DataFrame:
    """Rows read and rows passing every rule, in one pass over the input."""
    return df.agg(
        F.count(F.lit(1)).alias("raw_rows_read"),
        F.count_if(F.coalesce(_keep_all(df, model), F.lit(False))).alias("valid_rows"),
    )


def dedupe(df: DataFrame) -> DataFrame:
    """Exact whole-row duplicate removal (NULLs compare equal).

    Planned as a hash aggregate on all columns with a map-side partial
    aggregate, so a group of copies collapses inside each map task before
    the shuffle: a hot duplicate group costs one row per map task."""
    return df.dropDuplicates()
