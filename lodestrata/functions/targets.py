"""Yearly targets: one column per year, read according to the year of the row."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.contracts import TARGET_PREFIX
from lodestrata.functions.numbers import round2

PASS_SCORE = 743.0  # fixed value: lowest score that counts as literate


def target_years(columns: Iterable[str]) -> list[int]:
    """The years that have a target column, ascending."""
    found = (re.fullmatch(TARGET_PREFIX + r"(\d{4})", name) for name in columns)
    return sorted(int(match.group(1)) for match in found if match)


def _target(year: int) -> Column:
    return F.col(f"{TARGET_PREFIX}{year}")


def _target_of_row(years: list[int], year_column: str) -> Column:
    chosen = F.lit(None).cast("double")
    for year in reversed(years):
        chosen = F.when(F.col(year_column) == year, _target(year)).otherwise(chosen)
    return chosen


def target_in_force(columns: Iterable[str], year_column: str = "ano") -> Column:
    """The target of the row's own year, else the one of the last year, else null."""
    years = target_years(columns)
    if not years:
        return F.lit(None).cast("double")
    return F.coalesce(_target_of_row(years, year_column), _target(years[-1]))


def target_first_non_null(columns: Iterable[str]) -> Column:
    """The earliest target that is set, whatever the row's year."""
    years = target_years(columns)
    return F.coalesce(*map(_target, years)) if years else F.lit(None).cast("double")


def target_event_fallback(
    columns: Iterable[str], year_column: str = "ano", rate_column: str = "taxa_alfabetizacao"
) -> Column:
    """Target put on an event: own year, first year, last year, then the observed rate.

    Zero is used only where the input has no rate column at all.
    """
    columns = list(columns)
    years = target_years(columns)
    rate = F.col(rate_column).cast("double") if rate_column in columns else F.lit(0.0)
    if not years:
        return rate
    return F.coalesce(_target_of_row(years, year_column), _target(years[0]), _target(years[-1]), rate)


def gap(rate: Column, target: Column) -> Column:
    return rate - target


def gap2(rate: Column, target: Column) -> Column:
    return round2(gap(rate, target))


def reached(rate: Column, target: Column) -> Column:
    """True, false, or null when either side is unknown."""
    return F.when(rate.isNotNull() & target.isNotNull(), rate >= target)


def derived_flag(flag: Column, score: Column, cutoff: float = PASS_SCORE) -> Column:
    """The given flag, else "1" for a passing score and "0" for any other (a missing score too)."""
    return F.coalesce(flag, F.when(score >= cutoff, F.lit("1")).otherwise(F.lit("0")))


def with_target_gap(df: DataFrame) -> DataFrame:
    """Adds meta_vigente, gap_meta (two decimals) and atingiu_meta."""
    rate = F.col("taxa_alfabetizacao")
    in_force = target_in_force(df.columns)
    return df.withColumns(
        {"meta_vigente": in_force, "gap_meta": gap2(rate, in_force), "atingiu_meta": reached(rate, in_force)}
    )
