"""Validation rules as rows: all rules of a table are one aggregation per visit, and tables are compared by its results."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``rule`` names it; ``kind`` is one of FORMS or COMPARISONS, of ``column`` or of the rows for which ``where`` holds."""

    rule: str
    table: str
    kind: str
    column: str | None = None
    where: str | None = None
    #: what the kind takes: a number, a range, values, a pattern, or another table (and its column)
    value: object = None
    status: str = "Error"
    other_column: str | None = field(default=None)


def _rows(r: Rule) -> Column:
    return F.expr(r.where) if r.where else F.lit(True)


def _outside(r: Rule, good: Column) -> Column:
    """Rows whose column is known and not as it should be."""
    return F.count_if(_rows(r) & F.col(r.column).isNotNull() & ~good)


#: What is counted per visit, and whether the count is as it should be.
FORMS: dict[str, tuple[Callable[[Rule], Column], Callable[[Column, Rule], Column]]] = {
    "exactly": (lambda r: F.count_if(_rows(r)), lambda n, r: n == r.value),
    "at_least": (lambda r: F.count_if(_rows(r)), lambda n, r: n >= r.value),
    "at_most": (lambda r: F.count_if(_rows(r)), lambda n, r: n <= r.value),
    "required": (lambda r: F.count_if(_rows(r) & F.col(r.column).isNull()), lambda n, r: n == 0),
    "unique": (lambda r: F.count(F.when(_rows(r), F.col(r.column))) - F.count_distinct(F.when(_rows(r), F.col(r.column))), lambda n, r: n == 0),
    "one_of": (lambda r: _outside(r, F.col(r.column).isin(list(r.value))), lambda n, r: n == 0),
    "between": (lambda r: _outside(r, F.col(r.column).between(*r.value)), lambda n, r: n == 0),
    "pattern": (lambda r: _outside(r, F.col(r.column).rlike(r.value)), lambda n, r: n == 0),
}
#: What is taken of the own and of the other table, and how the two must be related.
COMPARISONS: dict[str, tuple[Callable[[Rule, str | None], Column], Callable[[Column, Column], Column]]] = {
    "as_many_as": (lambda r, _: F.count(F.lit(1)).cast("double"), lambda a, b: a == b),
    "no_more_than": (lambda r, c: F.coalesce(F.sum(c), F.lit(0.0)).cast("double"), lambda a, b: a <= b),
    "has_rows_if": (lambda r, _: F.count(F.lit(1)).cast("double"), lambda a, b: (b == 0) | (a > 0)),
}


def evaluate(tables: dict[str, DataFrame], rules: Iterable[Rule], visit: str) -> DataFrame:
    """(visit, rule, status, observed): every rule for every visit that any table has rows of.

    ``status`` is Pass or the rule's own; ``observed`` is what was counted, in a comparison the own value less the other.  A
    visit without rows in a table counts 0 there.  Each table is read and aggregated once, whatever the number of rules; the
    results, a row per visit and table, are joined by visit.
    """
    rules = list(rules)
    wanted: dict[str, dict[str, Column]] = {name: {} for name in tables}
    for k, r in enumerate(rules):
        if r.kind in FORMS:
            wanted[r.table][f"_own{k}"] = FORMS[r.kind][0](r).cast("double")
        elif r.kind in COMPARISONS:
            wanted[r.table][f"_own{k}"] = COMPARISONS[r.kind][0](r, r.column)
            wanted[r.value][f"_other{k}"] = COMPARISONS[r.kind][0](r, r.other_column or r.column)
        else:
            raise ValueError(f"rule {r.rule}: no kind {r.kind!r}")
    met = None
    for name, columns in wanted.items():
        if columns:
            one = tables[name].filter(F.col(visit).isNotNull()).groupBy(visit).agg(*(c.alias(n) for n, c in columns.items()))
            met = one if met is None else met.join(one, visit, "full")
    found = []
    for k, r in enumerate(rules):
        own = F.coalesce(F.col(f"_own{k}"), F.lit(0.0))
        if r.kind in FORMS:
            good, observed = FORMS[r.kind][1](own, r), own
        else:
            other = F.coalesce(F.col(f"_other{k}"), F.lit(0.0))
            good, observed = COMPARISONS[r.kind][1](own, other), own - other
        found.append(F.struct(F.lit(r.rule).alias("rule"), F.when(good, "Pass").otherwise(r.status).alias("status"), observed.alias("observed")))
    return met.select(visit, F.explode(F.array(*found)).alias("_f")).select(visit, "_f.*")
