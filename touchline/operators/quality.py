"""Data-quality rules, reports and gates."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import StructType

from touchline.schemas import table_layout


@dataclass(frozen=True)
class Rule:
    """One countable condition; ``broken`` is true for a row that violates it."""

    kind: str
    column: str
    broken: Column
    message: str  # with {n} for the number of violations


def null_rules(schema: StructType, columns: Sequence[str]) -> list[Rule]:
    """L1: one rule per declared non-null column that the frame has."""
    return [
        Rule("not_null", f.name, F.col(f.name).isNull(), f"{{n}} nulls in {f.name}")
        for f in schema
        if not f.nullable and f.name in columns
    ]


def non_negative(table: str, column: str) -> Rule:
    """L3"""
    return Rule(
        "non_negative", column, F.col(column) < 0, f"{table}.{column}: {{n}} below zero"
    )


def in_range(table: str, column: str, low: float, high: float) -> Rule:
    """Bounds included."""
    broken = (F.col(column) < low) | (F.col(column) > high)
    text = f"{table}.{column}: {{n}} beyond {low:g} to {high:g}"
    return Rule("range", column, broken, text)


def balanced(left: Sequence[str], right: Sequence[str], message: str) -> Rule:
    """L4: both sums must agree; a null in any of the columns exempts the row."""

    def total(names: Sequence[str]) -> Column:
        return reduce(lambda a, b: a + b, [F.col(n) for n in names])

    return Rule("balance", ",".join([*left, *right]), total(left) != total(right), message)


# Which statistics each business rule looks at.
NON_NEGATIVE = (
    "shots_on_goal", "shots_off_goal", "blocked_shots", "shots_insidebox",
    "shots_outsidebox", "fouls", "corner_kicks", "ball_possession", "yellow_cards",
    "red_cards", "goalkeeper_saves", "total_passes", "accurate_passes",
    "passes_success_percentage",
)
PERCENTAGES = ("ball_possession", "passes_success_percentage")
ATTEMPTS_BY_RESULT = ("shots_on_goal", "shots_off_goal", "blocked_shots")
ATTEMPTS_BY_PLACE = ("shots_insidebox", "shots_outsidebox")


def statistics_rules(
    table: str, columns: Sequence[str], expected_goals_max: float = 1
) -> tuple[list[Rule], list[str]]:
    """Business rules of the statistics table, and the issues of columns it lacks."""
    have = set(columns)
    missing = [
        f"{table} lacks {c}"
        for c in NON_NEGATIVE
        if c not in have
    ]
    rules = [non_negative(table, c) for c in NON_NEGATIVE if c in have]
    if have.issuperset(ATTEMPTS_BY_RESULT + ATTEMPTS_BY_PLACE):
        text = "{n} rows count attempts unlike by result and by place"
        rules.append(balanced(ATTEMPTS_BY_RESULT, ATTEMPTS_BY_PLACE, text))
    rules += [in_range(table, c, 0, 100) for c in PERCENTAGES if c in have]
    if "expected_goals_rate" in have:
        rules.append(in_range(table, "expected_goals_rate", 0, expected_goals_max))
        rules.append(non_negative(table, "expected_goals_rate"))
    return rules, missing


# Rule sets by table name; a table without an entry has no business rules.
BUSINESS_RULES: dict[str, Callable[..., tuple[list[Rule], list[str]]]] = {
    "silver_fixture_stats": statistics_rules
}


def schema_issues(df: DataFrame, expected: StructType, table: str) -> list[str]:
    """L2: missing columns, extra columns and type differences; starts no job."""
    actual = dict(df.dtypes)
    missing = [n for n in expected.names if n not in actual]
    extra = [n for n in actual if n not in expected.names]
    issues = [f"{table} lacks columns: {', '.join(sorted(missing))}"] if missing else []
    if extra:
        issues.append(f"{table} has undeclared columns: {', '.join(sorted(extra))}")
    for f in expected:
        want = f.dataType.simpleString()
        if f.name in actual and actual[f.name] != want:
            issues.append(f"{table}.{f.name} is {actual[f.name]}, declared {want}")
    return issues


def violation_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(kind, column, message, violations), one row per rule, from a single aggregate."""
    if not rules:
        return df.sparkSession.createDataFrame(
            [], "kind STRING, column STRING, message STRING, violations BIGINT"
        )
    counts = df.agg(*[F.count_if(r.broken).alias(f"r{i}") for i, r in enumerate(rules)])
    lines = [
        F.struct(
            F.lit(r.kind).alias("kind"),
            F.lit(r.column).alias("column"),
            F.replace(F.lit(r.message), F.lit("{n}"), F.col(f"r{i}").cast("string")).alias(
                "message"
            ),
            F.col(f"r{i}").alias("violations"),
        )
        for i, r in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*lines)))


@dataclass(frozen=True)
class Validation:
    """Outcome of ``validate``; valid when nothing was found."""

    quality_issues: list[str] = field(default_factory=list)
    schema_issues: list[str] = field(default_factory=list)
    business_issues: list[str] = field(default_factory=list)

    @property
    def is_valid(self) -> bool:
        return not (self.quality_issues or self.schema_issues or self.business_issues)

    def __str__(self) -> str:
        return (
            f"valid: {self.is_valid}; quality: {self.quality_issues}; "
            f"schema: {self.schema_issues}; business: {self.business_issues}"
        )


def validate(df: DataFrame, expected: StructType, table: str, **options: float) -> Validation:
    """Schema first (no job), then all counts in one job."""
    found = schema_issues(df, expected, table)
    rules = null_rules(expected, df.columns)
    business, missing = (
        BUSINESS_RULES[table](table, df.columns, **options)
        if table in BUSINESS_RULES
        else ([], [])
    )
    broken = violation_report(df, [*rules, *business]).filter("violations > 0").collect()
    return Validation(
        quality_issues=[r.message for r in broken if r.kind == "not_null"],
        schema_issues=found,
        business_issues=missing + [r.message for r in broken if r.kind != "not_null"],
    )


def gate(df: DataFrame, table: str, **options: float) -> DataFrame:
    """The frame itself, or an error that lists what is wrong with it."""
    outcome = validate(df, table_layout(table), table, **options)
    if not outcome.is_valid:
        raise ValueError(f"{table} failed validation: {outcome}")
    return df


def drop_violations(df: DataFrame, **expectations: str) -> DataFrame:
    """Keep rows that meet every SQL condition; works on batches and streams."""
    for condition in expectations.values():
        df = df.filter(F.expr(condition))
    return df


def drop_violations_counted(
    df: DataFrame, name: str, **expectations: str
) -> tuple[DataFrame, Observation]:
    """L5 with the number of rows seen and dropped per expectation, read after an action."""
    seen = Observation(name)
    counts = [
        F.count_if(~F.coalesce(F.expr(c), F.lit(False))).alias(f"dropped_{n}")
        for n, c in expectations.items()
    ]
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
    return drop_violations(observed, **expectations), seen


def empty_payloads(payloads: DataFrame, array: str = "stats") -> DataFrame:
    """Rows whose payload array is empty."""
    return payloads.filter(F.size(array) == 0)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The frame itself, or an error when it has no rows; reads at most one row."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df
