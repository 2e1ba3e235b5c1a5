"""Checks as data: a table of declarations, compiled into one aggregate per model."""

from __future__ import annotations

from dataclasses import astuple, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from comarca.operators.checks import Check, out_of_range, out_of_values, run_suite

SCHEMA = ("model string, check_name string, kind string, columns array<string>, arguments array<string>, "
          "severity string, allow bigint, tags array<string>")


def _number(text: str):
    return None if text == "" else float(text) if "." in text else int(text)


@dataclass(frozen=True)
class Declaration:
    """One row of the table.

    Kinds: ``not_null``, ``not_empty``, ``range`` (arguments: least and largest value, either may be
    empty), ``values`` (arguments: the accepted ones), ``unique`` (columns: the key) and
    ``expression`` (argument: SQL that holds; unknown passes).
    """

    name: str
    kind: str
    columns: tuple[str, ...] = ()
    arguments: tuple[str, ...] = ()
    severity: str = "error"
    allow: int = 0
    tags: tuple[str, ...] = ()

    def violation(self) -> Column:
        column = F.col(f"`{self.columns[0]}`") if self.columns else None
        if self.kind == "not_null":
            return column.isNull()
        if self.kind == "not_empty":
            return F.trim(column) == ""
        if self.kind == "range":
            return out_of_range(self.columns[0], *[_number(a) for a in self.arguments])
        if self.kind == "values":
            return out_of_values(self.columns[0], list(self.arguments))
        if self.kind == "expression":
            return ~F.expr(self.arguments[0])
        raise ValueError(f"unknown kind of check: {self.kind!r}")

    def check(self) -> Check:
        if self.kind == "unique":
            return Check(self.name, unique=tuple(self.columns), severity=self.severity, allow=self.allow)
        return Check(self.name, self.violation(), severity=self.severity, allow=self.allow)


def declaration_table(spark: SparkSession, suites: dict[str, list[Declaration]]) -> DataFrame:
    """The declarations of all models as rows."""
    rows = [(model, *[list(v) if isinstance(v, tuple) else v for v in astuple(d)])
            for model, declared in suites.items() for d in declared]
    return spark.createDataFrame(rows, SCHEMA)


def run_declared(declarations: DataFrame, models: dict[str, DataFrame],
                 tags: list[str] | None = None) -> DataFrame:
    """(model, check_name, severity, violations, status) of the declared checks of ``models``; with
    ``tags`` of those that have one of them.

    All row checks of a model share one pass over it.  The declarations, a few rows per model,
    are read while the plan is built; models without a selected check are not read.
    """
    wanted = declarations.where(F.col("model").isin(list(models)))
    if tags is not None:
        wanted = wanted.where(F.arrays_overlap("tags", F.array(*[F.lit(t) for t in tags])))
    chosen: dict[str, list[Declaration]] = {}
    for r in wanted.orderBy("model", "check_name").collect():
        chosen.setdefault(r.model, []).append(Declaration(
            r.check_name, r.kind, tuple(r["columns"]), tuple(r.arguments), r.severity, r.allow, tuple(r.tags)))
    results = [run_suite(models[m], declared).select(F.lit(m).alias("model"), "*") for m, declared in chosen.items()]
    if not results:
        return declarations.sparkSession.createDataFrame(
            [], "model string, check_name string, severity string, violations bigint, status string")
    return reduce(DataFrame.unionByName, results)
