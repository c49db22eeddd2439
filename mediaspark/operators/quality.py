"""Data-quality rules. All rules of a table are computed in one aggregation, over it or over its stored measures.

A rule gives a verdict and a detail. Verdicts are null-safe: an empty table has no value
out of range, and fails only rules that ask for rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT = "name string, passed boolean, detail string"


class Live:
    """Measures as aggregates over the table itself."""

    def rows(self) -> Column:
        return F.count(F.lit(1))

    def nulls(self, column: str) -> Column:
        return F.count_if(F.col(column).isNull())

    def least(self, column: str) -> Column:
        return F.min(column)

    def greatest(self, column: str) -> Column:
        return F.max(column)

    def broken(self, name: str, condition: str) -> Column:
        return F.count_if(F.expr(condition))

    def distinct(self, columns: Sequence[str]) -> Column:
        return F.count_distinct(F.struct(*columns))


@dataclass(frozen=True)
class Stored:
    """A table known by its schema and one row of measures taken when it was written; the table itself is not read."""

    table: DataFrame
    measures: DataFrame

    @property
    def columns(self) -> list[str]:
        return self.table.columns

    @property
    def schema(self):
        return self.table.schema

    def rows(self) -> Column:
        return F.max("rows")

    def nulls(self, column: str) -> Column:
        return F.max(F.col("nulls")[column])

    def least(self, column: str) -> Column:
        return F.max(F.col("least")[column]).cast(self.schema[column].dataType)

    def greatest(self, column: str) -> Column:
        return F.max(F.col("greatest")[column]).cast(self.schema[column].dataType)

    def broken(self, name: str, condition: str) -> Column:
        return F.max(F.col("broken")[name])

    def distinct(self, columns: Sequence[str]) -> Column:
        return F.max(F.col("distinct")[",".join(columns)])


@dataclass(frozen=True)
class Rule:
    """``passed`` and ``detail`` are aggregates over the table, literals, or functions of its measures."""

    name: str
    passed: Column | Callable[[Live | Stored], Column]
    detail: Column | Callable[[Live | Stored], Column]


def _text(*parts) -> Column:
    shown = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("none")) for p in parts]
    return F.concat(*shown)


def rows_between(name: str, low: int, high: int) -> Rule:
    return Rule(name, lambda m: m.rows().between(low, high), lambda m: _text(m.rows(), f" rows, {low} to {high} expected"))


def not_empty(name: str) -> Rule:
    return Rule(name, lambda m: m.rows() > 0, lambda m: _text(m.rows(), " rows"))


def no_nulls(name: str, column: str, where: Column | None = None) -> Rule:
    """No null in ``column``; among the rows that ``where`` keeps, if given, which only the table itself can tell."""
    if where is not None:
        broken = F.count_if(F.col(column).isNull() & where)
        return Rule(name, broken == 0, _text(broken, " nulls"))
    return Rule(name, lambda m: m.nulls(column) == 0, lambda m: _text(m.nulls(column), " nulls"))


def none_broken(name: str, condition: str, called: str, shown: str) -> Rule:
    """No row for which the SQL condition holds; stored measures have its count under the name ``called``."""
    return Rule(name, lambda m: m.broken(called, condition) == 0, lambda m: _text(m.broken(called, condition), f" {shown}"))


def unique(name: str, *columns: str) -> Rule:
    return Rule(name, lambda m: m.distinct(columns) == m.rows(), lambda m: _text(m.rows() - m.distinct(columns), " repeats"))


def within(name: str, column: str, low, high) -> Rule:
    def inside(m):
        return F.coalesce((m.least(column) >= low) & (m.greatest(column) <= high), F.lit(True))

    return Rule(name, inside, lambda m: _text(m.least(column), " to ", m.greatest(column)))


def at_least(name: str, column: str, low) -> Rule:
    return Rule(name, lambda m: F.coalesce(m.least(column) >= low, F.lit(True)), lambda m: _text("lowest ", m.least(column)))


def always_equals(name: str, column: str, value: str) -> Rule:
    def same(m):
        return (m.nulls(column) == 0) & F.coalesce((m.least(column) == value) & (m.greatest(column) == value), F.lit(True))

    return Rule(name, same, lambda m: _text(m.least(column), " to ", m.greatest(column), ", ", m.nulls(column), f" nulls, {value} expected"))


def has_like(name: str, column: str, counted: str, pattern: str) -> Rule:
    """Some value of ``counted`` sits in a row whose ``column`` has the form."""
    found = F.count_distinct(F.when(F.col(column).like(pattern), F.col(counted)))
    return Rule(name, found > 0, _text(found, f" distinct values like {pattern}"))


def same_rows(name: str, other: DataFrame | Stored) -> Rule:
    expected = row_count(other)
    return Rule(name, lambda m: m.rows() == expected, lambda m: _text(m.rows(), " rows, other table has ", expected))


def no_more_rows(name: str, other: DataFrame | Stored) -> Rule:
    limit = row_count(other)
    return Rule(name, lambda m: m.rows() <= limit, lambda m: _text(m.rows(), " rows, other table has ", limit))


def share_of(name: str, other: DataFrame | Stored, share: float) -> Rule:
    base = row_count(other)
    return Rule(name, lambda m: m.rows() >= base * share, lambda m: _text(m.rows(), f" rows, at least {share:.0%} expected of ", base))


def one_row_per(name: str, other: DataFrame | Stored, column: str) -> Rule:
    """As many rows as ``other`` has values of ``column``, null being one of them."""
    values = _measured(other, lambda m: m.distinct([column]))
    return Rule(name, lambda m: m.rows() == values, lambda m: _text(m.rows(), f" rows, values of {column}: ", values))


def fixed(name: str, passed: bool, detail: str) -> Rule:
    """A verdict known from the schema or the file system."""
    return Rule(name, F.lit(passed), F.lit(detail))


def has_column(name: str, df: DataFrame, column: str) -> Rule:
    present = column in df.columns
    return fixed(name, present, "present" if present else "missing")


def has_columns(name: str, df: DataFrame, columns: Iterable[str]) -> Rule:
    missing = sorted(set(columns) - set(df.columns))
    return fixed(name, not missing, f"missing: {', '.join(missing)}" if missing else "all present")


def has_type(name: str, df: DataFrame, column: str, kind: type) -> Rule:
    actual = df.schema[column].dataType
    return fixed(name, isinstance(actual, kind), actual.simpleString())


def _measured(table: DataFrame | Stored, measure: Callable[[Live | Stored], Column]) -> Column:
    """A measure of another table as a scalar subquery."""
    if isinstance(table, Stored):
        return table.measures.agg(measure(table)).scalar()
    return table.agg(measure(Live())).scalar()


def row_count(table: DataFrame | Stored) -> Column:
    """Row count as a scalar subquery."""
    return _measured(table, lambda m: m.rows())


def checks(table: DataFrame | Stored, rules: Iterable[Rule]) -> DataFrame:
    """Results of all rules, one row each, from one aggregation over the table, or over its stored measures."""
    source, rows = (table, table.measures) if isinstance(table, Stored) else (Live(), table)

    def of(part):
        return part(source) if callable(part) else part

    entries = [
        F.struct(
            F.lit(rule.name).alias("name"),
            F.coalesce(of(rule.passed), F.lit(False)).alias("passed"),
            of(rule.detail).alias("detail"),
        )
        for rule in rules
    ]
    return rows.agg(F.array(*entries).alias("found")).select(F.inline("found"))


def verdicts(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    """Results of rules that need no table."""
    return checks(spark.range(1), rules)


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def duplicate_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def references(facts: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """One row: fact rows whose key is known, unknown or null.

    Facts are counted per key before the join, so a hot key is one row in it.
    """
    known = keys.select(column).distinct().withColumn("_known", F.lit(True))
    counted = facts.groupBy(column).agg(F.count(F.lit(1)).alias("n")).join(known, column, "left")
    total = [
        F.sum(F.when(condition, F.col("n")).otherwise(0)).alias(name)
        for name, condition in (
            ("matched", F.col("_known").isNotNull()),
            ("orphans", F.col("_known").isNull() & F.col(column).isNotNull()),
            ("without_key", F.col(column).isNull()),
        )
    ]
    return counted.agg(*(F.coalesce(c, F.lit(0)).alias(n) for c, n in zip(total, ("matched", "orphans", "without_key"))))


def null_counts(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Nulls per column as rows, from one pass."""
    names = list(columns or df.columns)
    entries = [F.struct(F.lit(n).alias("column_name"), F.count_if(F.col(n).isNull()).alias("nulls")) for n in names]
    return df.agg(F.array(*entries).alias("found")).select(F.inline("found"))
