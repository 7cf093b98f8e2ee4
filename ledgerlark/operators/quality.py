"""Constraint checks as aggregate jobs: one report row per check with the number of violating rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.columns import count_where
from ledgerlark.sources.schemas import SPECS, Field, TableSpec
from ledgerlark.sources.tables import Tables

REPORT = ("table", "check", "columns", "violations")


class ConstraintError(ValueError):
    """Raised with the list of violated checks."""


def _report_row(df: DataFrame, table: str, check: str, columns: str, violations: Column) -> DataFrame:
    return df.agg(F.coalesce(violations, F.lit(0)).cast("long").alias("violations")).select(
        F.lit(table).alias("table"), F.lit(check).alias("check"), F.lit(columns).alias("columns"), "violations"
    )


def stack_reports(reports: list[DataFrame | None]) -> DataFrame:
    return reduce(DataFrame.unionByName, [r for r in reports if r is not None])


def duplicate_keys(df: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def check_key(df: DataFrame, table: str, keys: tuple[str, ...]) -> DataFrame:
    """Rows beyond the first of each key value."""
    return _report_row(duplicate_keys(df, keys), table, "primary_key", ", ".join(keys), F.sum(F.col("rows") - 1))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child values without a parent and the number of rows that hold them; NULL refers to nothing and passes.

    The child is folded to one row per value first, so a value that fills a third of the table is a single row in the
    join.
    """
    values = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    return values.join(parent.select(F.col(parent_key).alias(column)), column, "left_anti")


def check_reference(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_table: str, parent_key: str
) -> DataFrame:
    found = orphans(child, column, parent, parent_key)
    return _report_row(found, table, "foreign_key", f"{column} -> {parent_table}.{parent_key}", F.sum("rows"))


def field_conditions(field: Field) -> list[tuple[str, Column]]:
    """(check name, violation condition) pairs of one column. A NULL satisfies everything but not_null."""
    col = F.col(field.name)
    checks = []
    if field.required:
        checks.append(("not_null", col.isNull()))
    if field.domain:
        checks.append(("domain", ~col.isin(*field.domain)))
    if field.low is not None or field.high is not None:
        outside = F.lit(False)
        if field.low is not None:
            outside = outside | (col < field.low)
        if field.high is not None:
            outside = outside | (col > field.high)
        checks.append(("range", outside))
    if field.max_length is not None:
        checks.append(("length", F.length(col.cast("string")) > field.max_length))
    return checks


CHECK_KINDS = ("not_null", "domain", "range", "length")


def check_rows(df: DataFrame, spec: TableSpec, kinds: tuple[str, ...] = CHECK_KINDS) -> DataFrame | None:
    """The per-row checks of a table in one scan and one aggregate, turned into report rows; None if it declares none."""
    checks = [(name, f.name, bad) for f in spec.fields for name, bad in field_conditions(f) if name in kinds]
    if not checks:
        return None
    counts = df.agg(*[count_where(bad).alias(f"c{i}") for i, (_, _, bad) in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(spec.name).alias("table"),
            F.lit(name).alias("check"),
            F.lit(column).alias("columns"),
            F.col(f"c{i}").alias("violations"),
        )
        for i, (name, column, _) in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def validate(t: Tables, specs: tuple[TableSpec, ...] = SPECS) -> DataFrame:
    """Every declared constraint of every table as one lazy report."""
    reports = []
    for spec in specs:
        reports.append(check_rows(t[spec.name], spec))
        reports.append(check_key(t[spec.name], spec.name, spec.key))
        for column, (parent, parent_key) in spec.references.items():
            reports.append(check_reference(t[spec.name], spec.name, column, t[parent], parent, parent_key))
    return stack_reports(reports).select(*REPORT)


def _again(own: DataFrame, spec: TableSpec, stored: DataFrame) -> DataFrame:
    """Rows of a batch whose key is stored already."""
    key = list(spec.key)
    again = own.select(*key).join(stored.select(*key), key, "left_semi")
    return _report_row(again, spec.name, "primary_key", f"{', '.join(key)} (stored)", F.count("*"))


def validate_batch(batch: Tables, stored: dict[str, DataFrame], specs: tuple[TableSpec, ...] = SPECS) -> DataFrame:
    """The constraints of a batch that is to join a store whose own rows were checked when they came.

    Only rows of the batch are counted: its keys against themselves and against the stored keys, its references against
    the stored and its own parents. `stored` needs the key columns alone, and only those keys that the batch adds or
    refers to; a table that holds none of them may be missing.
    """
    reports = [repeated_keys(batch, stored, specs)] if stored else []
    for spec in specs:
        own = batch[spec.name]
        reports.append(check_rows(own, spec))
        reports.append(check_key(own, spec.name, spec.key))
        for column, (parent, parent_key) in spec.references.items():
            parents = batch[parent].select(parent_key)
            if parent in stored:
                parents = stored[parent].select(parent_key).union(parents)
            reports.append(check_reference(own, spec.name, column, parents, parent, parent_key))
    return stack_reports(reports).select(*REPORT)


def repeated_keys(batch: Tables, stored: dict[str, DataFrame], specs: tuple[TableSpec, ...] = SPECS) -> DataFrame:
    """Of the checks of a batch those that rows stored since can break; `stored` is not empty."""
    return stack_reports([_again(batch[s.name], s, stored[s.name]) for s in specs if s.name in stored]).select(*REPORT)


def assert_valid(report: DataFrame) -> None:
    """Raise if any check found a violation (an action; the report has one row per declared constraint)."""
    broken = report.where(F.col("violations") > 0).collect()
    if broken:
        raise ConstraintError("; ".join(f"{r.table}: {r.check}({r.columns}) {r.violations}" for r in broken))


def assert_unique(df: DataFrame, keys: tuple[str, ...], table: str) -> None:
    assert_valid(check_key(df, table, keys))


def row_counts(t: Tables) -> DataFrame:
    return stack_reports([df.agg(F.count("*").alias("rows")).withColumn("table", F.lit(name)) for name, df in t.items()])


def null_counts(df: DataFrame, table: str) -> DataFrame:
    """NULLs per column in one scan."""
    counts = df.agg(*[count_where(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns]
    return counts.select(F.lit(table).alias("table"), F.inline(F.array(*rows)))


def unmapped_categories(t: Tables) -> DataFrame:
    """Product categories without a translation, with the number of products in each."""
    key = "product_category_name"
    found = orphans(t.products, key, t.product_category_translation, key)
    return found.withColumnRenamed("rows", "products")
