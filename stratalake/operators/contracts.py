"""Declarative data contracts and model tests (Q1-Q5, DT1-DT5, J6).

A contract is a list of :class:`Rule`.  Evaluation compiles every row-level
rule of one table into ONE aggregate (``count_if`` per rule, partial
aggregation on the executors), plus one grouped count per further ``unique``
rule.  All ``relationships`` rules of a table share one more pass: a grouped
count of their values and an anti join of the distinct ones.  The result is a
small report DataFrame, one row per rule; nothing but report rows ever reaches
the driver.

Nulls pass ``in_set``, ``between`` and ``unique`` and are not checked by
``relationships``; ``not_null`` is the rule that catches them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import missing_from

REPORT_COLS = ("table_name", "rule", "column_name", "violations", "success")


@dataclass(frozen=True)
class Rule:
    kind: str                      # not_null | unique | in_set | between | relationships
    column: str
    values: tuple = ()             # in_set
    min_value: Any = None          # between (inclusive)
    max_value: Any = None          # between (inclusive)
    to: str | None = None          # relationships: referenced table name
    field: str | None = None       # relationships: referenced column

    def violation(self) -> Column:
        """Row-level predicate that is true for a violating row."""
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "in_set":
            return c.isNotNull() & ~c.isin(list(self.values))
        if self.kind == "between":
            bad = F.lit(False)
            if self.min_value is not None:
                bad = bad | (c < F.lit(self.min_value))
            if self.max_value is not None:
                bad = bad | (c > F.lit(self.max_value))
            return c.isNotNull() & bad
        raise ValueError(f"{self.kind} is not a row-level rule")


def not_null(c): return Rule("not_null", c)
def unique(c): return Rule("unique", c)
def in_set(c, values): return Rule("in_set", c, values=tuple(values))
def between(c, min_value=None, max_value=None): return Rule("between", c, min_value=min_value, max_value=max_value)
def relationships(c, to, field): return Rule("relationships", c, to=to, field=field)


# ---- fixed values: the silver contracts ----------------------------------------
SEGMENTS = ("SMB", "MID", "ENT")
CATEGORIES = ("HW", "SW", "ACC")
STATUSES = ("NEW", "PAID", "SHIPPED", "CANCELLED", "REFUNDED")

SILVER_SUITES: dict[str, list[Rule]] = {
    "customers": [not_null("customer_id"), unique("customer_id"),
                  in_set("segment", SEGMENTS), not_null("city")],
    "products": [not_null("product_id"), unique("product_id"),
                 in_set("category", CATEGORIES)],
    "orders": [not_null("order_id"), unique("order_id"), not_null("customer_id"),
               in_set("status", STATUSES)],
    "order_items": [not_null("order_item_id"), unique("order_item_id"),
                    between("quantity", min_value=1)],
}

# ---- fixed values: the gold model tests ----------------------------------------
GOLD_TESTS: dict[str, list[Rule]] = {
    "dim_customer": [not_null("customer_sk"), unique("customer_sk"), not_null("customer_id")],
    "dim_product": [not_null("product_sk"), unique("product_sk")],
    "dim_date": [not_null("date_day"), unique("date_day")],
    "fact_sales": [not_null("order_item_id"), unique("order_item_id"),
                   not_null("customer_sk"),
                   relationships("customer_sk", "dim_customer", "customer_sk"),
                   relationships("product_sk", "dim_product", "product_sk"),
                   not_null("amount"),
                   in_set("status", STATUSES)],
}
# --------------------------------------------------------------------------------


def _row(table: str, rule: str, column: str, violations: Column) -> Column:
    return F.struct(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"),
                    F.lit(column).alias("column_name"),
                    violations.cast("bigint").alias("violations"))


def duplicate_rows(df: DataFrame, column: str) -> DataFrame:
    """Q2 core: rows whose non-null ``column`` value occurs more than once
    (one-row DataFrame ``n``).  Grouped count with map-side partial counts."""
    return (df.where(F.col(column).isNotNull())
              .groupBy(column).agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > 1)
              .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n")))


def orphan_rows(df: DataFrame, rules: Sequence[Rule], refs: dict[str, DataFrame]) -> DataFrame:
    """J6 core: for each relationships rule, the rows whose non-null value is
    absent from the referenced column (one row, columns ``n0``, ``n1``, ...).

    One pass over ``df`` for all rules: rows are counted per (rule, value) with
    map-side partial counts, so a value held by a third of all rows collapses
    before any shuffle; only the distinct values then meet the referenced keys,
    in an anti join (which cannot fan out, even if a referenced key repeats).
    Referenced keys are cast to the checked column's type and both compared as
    text, which lets rules on columns of different types share the join."""
    def entry(i: int, value: Column) -> Column:
        return F.struct(F.lit(i).alias("rule"), value.cast("string").alias("value"))

    cells = F.array(*[F.when(F.col(r.column).isNotNull(), entry(i, F.col(r.column))) for i, r in enumerate(rules)])
    per_value = df.select(F.explode(cells).alias("__k")).groupBy("__k").agg(F.count(F.lit(1)).alias("n"))
    known = reduce(DataFrame.unionAll, [
        refs[r.to].select(entry(i, F.col(r.field).cast(df.schema[r.column].dataType)).alias("__k"))
        for i, r in enumerate(rules)])
    return missing_from(per_value, known, "__k").agg(*[
        F.coalesce(F.sum(F.when(F.col("__k.rule") == i, F.col("n"))), F.lit(0)).cast("bigint").alias(f"n{i}")
        for i in range(len(rules))])


def evaluate(df: DataFrame, table: str, rules: Sequence[Rule],
             refs: dict[str, DataFrame] | None = None) -> DataFrame:
    """Evaluate ``rules`` on one table in ONE plan; one report row per rule.

    * row-level rules become ``count_if`` terms of one aggregate;
    * the first ``unique`` rule groups by its column first (map-side partial
      counts, so a hot value collapses before the shuffle) and the other terms
      are summed through that grouping; further ``unique`` rules get their own
      grouped count;
    * ``relationships`` rules are one more branch (:func:`orphan_rows`): rows
      are counted per key value map-side and only the distinct values meet the
      referenced keys, so no shuffle ever carries a hot key's rows.  The plan
      is the same at every size.
    """
    base = df.alias("__t")
    terms: list[tuple[Rule, Column]] = []
    apart: list[Rule] = []
    for r in rules:
        if r.kind in ("not_null", "in_set", "between"):
            terms.append((r, r.violation()))
        elif r.kind == "relationships":
            if not refs or r.to not in refs:
                raise KeyError(f"relationships rule needs table {r.to!r}")
            apart.append(r)
    uniques = [r for r in rules if r.kind == "unique"]
    names = [f"__v{i}" for i in range(len(terms))]

    if uniques:
        u = uniques[0].column
        per_value = base.groupBy(F.col(f"__t.{u}").alias("__u")).agg(
            F.count(F.lit(1)).alias("__n"),
            *[F.count_if(t).alias(n) for (_, t), n in zip(terms, names)])
        totals = {n: F.sum(n) for n in names}
        totals[u] = F.sum(F.when(F.col("__u").isNotNull() & (F.col("__n") > 1), F.col("__n")))
        source = per_value
    else:
        totals = {n: F.count_if(t) for (_, t), n in zip(terms, names)}
        source = base
    in_terms = [t[0] for t in terms]
    cells = []
    for r in rules:
        if r.kind == "unique" and r is uniques[0]:
            cells.append(_row(table, r.kind, r.column, F.coalesce(totals[r.column], F.lit(0))))
        elif any(r is x for x in in_terms):
            n = names[next(i for i, x in enumerate(in_terms) if x is r)]
            cells.append(_row(table, r.kind, r.column, F.coalesce(totals[n], F.lit(0))))
    branches = []
    if cells:
        branches.append(source.agg(F.array(*cells).alias("r")).select(F.inline("r")))
    for r in uniques[1:]:
        branches.append(duplicate_rows(df, r.column).select(F.inline(F.array(
            _row(table, r.kind, r.column, F.col("n"))))))
    if apart:
        branches.append(orphan_rows(df, apart, refs).select(F.inline(F.array(*[
            _row(table, r.kind, r.column, F.col(f"n{i}")) for i, r in enumerate(apart)]))))
    out = reduce(lambda a, b: a.unionByName(b), branches)
    return out.withColumn("success", F.col("violations") == 0)


def suite_report(tables: dict[str, DataFrame],
                 suites: dict[str, list[Rule]] = SILVER_SUITES) -> DataFrame:
    """Q5: every rule of every suite -> (table_name, rule, column_name,
    violations, success)."""
    out = None
    for table, rules in suites.items():
        r = evaluate(tables[table], table, rules, refs=tables)
        out = r if out is None else out.unionByName(r)
    return out


def scd2_current_checks(dim: DataFrame, key: str = "customer_id",
                        table: str = "dim_customer") -> DataFrame:
    """DT5 (+D5): keys with more than one open version, and keys with none.
    One grouped pass; each key collapses to one row before the final count."""
    per_key = dim.groupBy(key).agg(F.count_if(F.col("is_current")).alias("open"))
    agg = per_key.agg(F.array(
        _row(table, "one_current_version", key, F.count_if(F.col("open") > 1)),
        _row(table, "has_current_version", key, F.count_if(F.col("open") == 0)),
    ).alias("r"))
    return agg.select(F.inline("r")).withColumn("success", F.col("violations") == 0)


def model_test_report(gold: dict[str, DataFrame]) -> DataFrame:
    """DT1-DT5 over the gold tables."""
    rep = suite_report(gold, GOLD_TESTS)
    return rep.unionByName(scd2_current_checks(gold["dim_customer"]))


def failed_rules(report: DataFrame) -> list[tuple[str, str, str, int]]:
    """The failing rows of a report (a report has one row per rule)."""
    return [(r.table_name, r.rule, r.column_name, r.violations)
            for r in report.where(~F.col("success")).collect()]


class ContractError(RuntimeError):
    """Raised by a gate when a contract or model test fails."""
