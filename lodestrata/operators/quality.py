"""Data-quality rules: one report per table, a gate that stops a run, and row quarantine."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from lodestrata.contracts import EVENT_ENTITY, TARGET_PREFIX, TARGET_YEARS
from lodestrata.operators.dedup import mark_repeats

logger = logging.getLogger(__name__)

REASON = "_motivo_quarentena"
ROW_KINDS = ("not_null", "regex", "range", "accepted_values", "key_length")
TABLE_KINDS = ("unique", "min_count")


class QualityError(ValueError):
    """At least one critical rule failed."""


@dataclass(frozen=True)
class Rule:
    kind: str
    column: str | None = None
    pattern: str | None = None
    minimum: float | None = None
    maximum: float | None = None
    values: tuple[str, ...] = ()
    critical: bool = True

    @property
    def label(self) -> str:
        return f"{self.kind}:{self.column}" if self.column else self.kind


def not_null(column: str, critical: bool = True) -> Rule:
    return Rule("not_null", column, critical=critical)


def unique(column: str, critical: bool = True) -> Rule:
    return Rule("unique", column, critical=critical)


def matches(column: str, pattern: str, critical: bool = True) -> Rule:
    return Rule("regex", column, pattern=pattern, critical=critical)


def in_range(
    column: str, minimum: float | None = None, maximum: float | None = None, critical: bool = True
) -> Rule:
    return Rule("range", column, minimum=minimum, maximum=maximum, critical=critical)


def accepted(column: str, values: Iterable[str], critical: bool = True) -> Rule:
    return Rule("accepted_values", column, values=tuple(values), critical=critical)


def key_length(column: str, length: int, critical: bool = True) -> Rule:
    return Rule("key_length", column, minimum=length, critical=critical)


def min_count(rows: int, critical: bool = True) -> Rule:
    return Rule("min_count", minimum=rows, critical=critical)


# --- Fixed values: patterns and the rules of each entity and layer -------------------------------

STATE_CODE = r"^[A-Z]{2}$"
MUNICIPALITY_KEY = r"^\d{7}$"
FIRST_YEAR = 2023
LEAST_ROWS = {"uf": 27, "municipio": 1000}


def rule_book(
    state_code: str = STATE_CODE,
    first_year: int = FIRST_YEAR,
    last_year: int = TARGET_YEARS[-1],
    least_rows: Mapping[str, int] = MappingProxyType(LEAST_ROWS),
) -> dict[tuple[str, str], list[Rule]]:
    """All rules; the arguments fit them to data with other codes, years or sizes of the directories."""
    last_target = f"{TARGET_PREFIX}{last_year}"
    return {
        ("uf", "bronze"): [not_null("sigla"), unique("sigla"), matches("sigla", state_code), min_count(least_rows["uf"])],
        ("uf", "silver"): [not_null("sigla_uf"), unique("sigla_uf"), matches("sigla_uf", state_code)],
        ("uf", "gold"): [min_count(1), not_null("sigla_uf")],
        ("municipio", "bronze"): [
            not_null("id_municipio"),
            matches("id_municipio", MUNICIPALITY_KEY),
            not_null("sigla_uf"),
            min_count(least_rows["municipio"]),
        ],
        ("municipio", "silver"): [
            not_null("id_municipio"),
            unique("id_municipio"),
            matches("id_municipio", MUNICIPALITY_KEY),
            not_null("sigla_uf"),
        ],
        ("municipio", "gold"): [min_count(1), not_null("id_municipio")],
        ("meta_brasil", "bronze"): [
            not_null("ano"),
            in_range("ano", first_year, last_year),
            not_null("taxa_alfabetizacao"),
            in_range("taxa_alfabetizacao", 0, 100),
        ],
        ("meta_brasil", "silver"): [not_null("ano"), not_null(last_target), in_range(last_target, 0, 100)],
        ("meta_brasil", "gold"): [min_count(1), not_null("taxa_alfabetizacao"), not_null("meta_vigente")],
        ("meta_uf", "bronze"): [not_null("sigla_uf"), not_null("ano"), in_range("taxa_alfabetizacao", 0, 100)],
        ("meta_uf", "silver"): [
            not_null("sigla_uf"),
            not_null("ano"),
            not_null("taxa_alfabetizacao", critical=False),
            in_range("taxa_alfabetizacao", 0, 100),
        ],
        ("meta_uf", "gold"): [min_count(1), not_null("sigla_uf"), not_null("gap_meta", critical=False)],
        ("meta_municipio", "bronze"): [
            not_null("id_municipio"),
            matches("id_municipio", MUNICIPALITY_KEY),
            not_null("ano"),
            in_range("taxa_alfabetizacao", 0, 100),
        ],
        ("meta_municipio", "silver"): [
            not_null("id_municipio"),
            not_null("ano"),
            not_null("taxa_alfabetizacao", critical=False),
            in_range("taxa_alfabetizacao", 0, 100),
            not_null("gap_meta", critical=False),
        ],
        ("meta_municipio", "gold"): [
            min_count(1),
            not_null("id_municipio"),
            not_null("taxa_alfabetizacao"),
            not_null("meta_vigente"),
        ],
        ("alunos", "bronze"): [
            not_null("id_aluno"),
            not_null("id_municipio"),
            matches("id_municipio", MUNICIPALITY_KEY),
            min_count(1),
        ],
        ("alunos", "silver"): [
            not_null("id_aluno"),
            not_null("id_municipio"),
            in_range("proficiencia", 0, 1000, critical=False),
        ],
        ("alunos", "gold"): [min_count(1), not_null("total_alunos"), not_null("taxa_alfabetizacao_calc")],
        (EVENT_ENTITY, "bronze"): [
            not_null("event_id"),
            not_null("event_type"),
            not_null("id_municipio"),
            matches("id_municipio", MUNICIPALITY_KEY),
            min_count(1),
        ],
        (EVENT_ENTITY, "silver"): [not_null("event_id"), unique("event_id")],
        (EVENT_ENTITY, "gold"): [min_count(1)],
    }


# --- End of fixed values --------------------------------------------------------------------------


def rules_for(entity: str, layer: str, **fit) -> list[Rule]:
    return rule_book(**fit)[entity, layer.lower()]


def _full_match(value: Column, pattern: str) -> Column:
    # \z: in Java a bare $ would let a trailing line break pass.
    return value.rlike(rf"^(?:{pattern})\z")


def violates(rule: Rule, null_fails: bool = False) -> Column:
    """True for a row that breaks the rule, never null.

    A null passes every rule but ``not_null``; with ``null_fails`` (row quarantine) it also breaks
    the pattern and accepted-value rules.
    """
    value = F.col(rule.column)
    if rule.kind == "not_null":
        return value.isNull()
    if rule.kind == "regex":
        broken = ~_full_match(value.cast("string"), rule.pattern)
    elif rule.kind == "accepted_values":
        broken = ~value.isin(*rule.values)
    elif rule.kind == "key_length":
        broken = F.length(value) != int(rule.minimum)
    elif rule.kind == "range":
        number, null_fails = value.try_cast("double"), False
        broken = F.lit(False)
        if rule.minimum is not None:
            broken = broken | (number < float(rule.minimum))
        if rule.maximum is not None:
            broken = broken | (number > float(rule.maximum))
    else:
        raise ValueError(f"{rule.kind} is no rule on single rows")
    return F.coalesce(broken, F.lit(null_fails))


def _measure(rule: Rule) -> Column:
    """What a rule counts over the whole table: rows that break it, or all rows for ``min_count``."""
    if rule.kind in ROW_KINDS:
        return F.count_if(violates(rule))
    rows = F.count(F.lit(1))
    if rule.kind == "min_count":
        return rows
    if rule.kind == "unique":
        value = F.col(rule.column)
        null_value = F.coalesce(F.max(F.when(value.isNull(), 1).otherwise(0)), F.lit(0))
        return rows - F.count_distinct(value) - null_value
    return F.lit(None).cast("bigint")


def _passed(rule: Rule, measure: Column) -> Column:
    if rule.kind == "min_count":
        return measure >= int(rule.minimum)
    if rule.kind in (*ROW_KINDS, "unique"):
        return measure == 0
    return F.lit(False)


def _detail(rule: Rule, measure: Column) -> Column:
    text = {
        "not_null": f"nulls in {rule.column}: %d",
        "unique": f"repeated values in {rule.column}: %d",
        "regex": f"values of {rule.column} outside {rule.pattern}: %d",
        "range": f"values of {rule.column} outside [{rule.minimum}, {rule.maximum}]: %d",
        "accepted_values": f"values of {rule.column} not accepted: %d",
        "key_length": f"values of {rule.column} of another length: %d",
        "min_count": f"rows: %d, at least {rule.minimum} wanted",
    }.get(rule.kind)
    if text is None:
        return F.lit(f"unknown rule: {rule.kind}")
    before, after = text.split("%d")
    return F.concat(F.lit(before), measure.cast("string"), F.lit(after))


def quality_reports(df: DataFrame, sets: Mapping[tuple[str, ...], Sequence[Rule]], labels: Sequence[str]) -> DataFrame:
    """One row per rule of several rule sets on one table, after the columns ``labels`` that name the set.

    The table is read once for all sets; a measure that several sets ask for is taken once.
    """
    named = [(at, place, rule) for at, rules in sets.items() for place, rule in enumerate(rules, start=1)]
    names = {rule: f"m{i}" for i, rule in enumerate(dict.fromkeys(rule for _, _, rule in named))}
    measured = df.agg(F.count(F.lit(1)).alias("rows"), *(_measure(rule).alias(name) for rule, name in names.items()))
    rows = [
        F.struct(
            *(F.lit(value).alias(label) for label, value in zip(labels, at, strict=True)),
            F.lit(place).alias("ordem"),
            F.lit(rule.label).alias("check"),
            F.lit(rule.kind).alias("tipo"),
            # A rule nobody can evaluate must not pass quietly.
            F.lit(rule.critical or rule.kind not in (*ROW_KINDS, *TABLE_KINDS)).alias("critico"),
            _passed(rule, F.col(names[rule])).alias("aprovado"),
            F.col(names[rule]).alias("medida"),
            _detail(rule, F.col(names[rule])).alias("detalhe"),
        )
        for at, place, rule in named
    ]
    return measured.select(F.inline(F.array(*rows)))


def quality_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule, all measured in a single pass over the table."""
    return quality_reports(df, {(): rules}, ())


def quality_gate(df: DataFrame, rules: Sequence[Rule]) -> list[Row]:
    """The report, or QualityError naming every critical rule that failed. Other failures are logged.

    Only the report reaches the driver: one row per rule.
    """
    report = quality_report(df, rules).orderBy("ordem").collect() if rules else []
    for row in report:
        level = logging.INFO if row.aprovado else logging.WARNING
        logger.log(level, "quality %s: %s (%s)", "ok" if row.aprovado else "FAILED", row.check, row.detalhe)
    failed = [f"{row.check}: {row.detalhe}" for row in report if row.critico and not row.aprovado]
    if failed:
        raise QualityError("critical rules failed:\n- " + "\n- ".join(failed))
    return report


def with_row_reasons(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All rows, with the columns of the critical rules each one breaks (``;`` between), or null.

    ``unique`` leaves one row of a key alone and marks the others; ``min_count`` is no rule on rows.
    """
    marks: list[Column] = []
    flags: list[str] = []
    for rule in (r for r in rules if r.critical and r.kind != "min_count"):
        if rule.kind == "unique":
            flags.append(f"_repeat_{len(flags)}")
            df = mark_repeats(df, rule.column, flags[-1])
            broken = F.col(flags[-1])
        elif rule.kind in ROW_KINDS:
            broken = violates(rule, null_fails=True)
        else:
            raise QualityError(f"unknown rule: {rule.kind}")
        marks.append(F.when(broken, F.lit(rule.column)))
    reason = F.nullif(F.concat_ws(";", *marks), F.lit("")) if marks else F.lit(None).cast("string")
    return df.withColumn(REASON, reason).drop(*flags)


def quarantine_split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(rows that break no critical rule, rows set aside with their reason)."""
    judged = with_row_reasons(df, rules)
    return judged.where(F.col(REASON).isNull()).drop(REASON), judged.where(F.col(REASON).isNotNull())
