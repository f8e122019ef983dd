"""Data-quality metrics and declared-constraint checks, as DataFrames.

Metrics are single aggregations (one pass, partial aggregation before the
shuffle); a check never collects rows to the driver. ``validate`` returns a
report DataFrame; ``enforce`` raises when a rule is broken.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.numeric import pct_of_counts


def customer_quality(customers: DataFrame) -> DataFrame:
    """rows, null cities, duplicate e-mails (rows - distinct e-mails, null counted once)."""
    return customers.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("city").isNull()).alias("null_cities"),
        F.countDistinct("email").alias("_d"),
        F.max(F.col("email").isNull().cast("long")).alias("_n"),
    ).select("rows", "null_cities",
             (F.col("rows") - F.col("_d") - F.coalesce(F.col("_n"), F.lit(0))).alias("duplicate_emails"))


def order_quality(tagged: DataFrame) -> DataFrame:
    """rows in, clean, quarantined, and quarantine rate in percent (0 for no rows)."""
    return quality_rates(tagged.agg(F.count(F.lit(1)).alias("rows_in"),
                                    F.count_if(F.col("rejection_reason").isNull()).alias("rows_clean")))


def quality_rates(agg: DataFrame) -> DataFrame:
    """The same from rows of (rows_in, rows_clean), such as a write has counted."""
    rej = F.col("rows_in") - F.col("rows_clean")
    rate = F.when(F.col("rows_in") > 0, pct_of_counts(rej, F.col("rows_in")))
    return agg.select("rows_in", "rows_clean", rej.alias("rows_rejected"),
                      F.coalesce(rate, F.lit(0).cast("decimal(38,2)")).alias("reject_rate_pct"))


def reject_reason_counts(tagged: DataFrame) -> DataFrame:
    return (tagged.where(F.col("rejection_reason").isNotNull())
            .groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("rows")))


# ------------------------------------------------------------------ constraints
@dataclass
class TableRules:
    """Declared constraints of one table (the warehouse DDL, as data)."""
    name: str
    df: DataFrame
    not_null: list[str] = field(default_factory=list)
    unique: list[list[str]] = field(default_factory=list)
    checks: dict[str, Column] = field(default_factory=dict)     # name -> predicate that must hold
    max_length: dict[str, int] = field(default_factory=dict)
    foreign_keys: list[tuple[str, DataFrame, str]] = field(default_factory=list)  # col, parent, parent col


REPORT = "table_name string, constraint_name string, violations long"


def _flagged(r: TableRules) -> DataFrame:
    """The table with one flag per foreign key: true where the value has a parent."""
    out = r.df
    for i, (col, parent, pcol) in enumerate(r.foreign_keys):
        keys = (parent.select(F.col(pcol).alias(f"_p{i}")).where(F.col(f"_p{i}").isNotNull()).distinct()
                .withColumn(f"_f{i}", F.lit(True)))
        out = out.join(keys, F.col(col) == F.col(f"_p{i}"), "left").drop(f"_p{i}")
    return out


def rule_counts(r: TableRules) -> list[tuple[str, Column]]:
    """(rule, predicate that is true for a breach) of the NOT NULL, CHECK and length rules."""
    return ([(f"not_null:{c}", F.col(c).isNull()) for c in r.not_null]
            + [(f"check:{nm}", ~F.coalesce(pred, F.lit(True))) for nm, pred in r.checks.items()]
            + [(f"length:{c}<={n}", F.coalesce(F.length(c) > n, F.lit(False))) for c, n in r.max_length.items()])


def validate(rules: list[TableRules]) -> DataFrame:
    """One row per (table, constraint) with the number of violating rows.

    A table is read once for its NOT NULL, CHECK, length and FOREIGN KEY rules:
    parents join as distinct flagged keys, and one aggregation counts them all
    (a null foreign key is no violation). UNIQUE counts rows whose key occurs more
    than once (grouped, partially aggregated).
    """
    parts: list[DataFrame] = []
    for r in rules:
        exprs = [(name, F.count_if(broken)) for name, broken in rule_counts(r)]
        for i, (c, _, _) in enumerate(r.foreign_keys):
            exprs.append((f"foreign_key:{c}", F.count_if(F.col(c).isNotNull() & F.col(f"_f{i}").isNull())))
        if exprs:
            agg = _flagged(r).agg(*[e.alias(f"_c{i}") for i, (_, e) in enumerate(exprs)])
            stack = ", ".join(f"'{nm}', _c{i}" for i, (nm, _) in enumerate(exprs))
            parts.append(agg.selectExpr(f"stack({len(exprs)}, {stack}) AS (constraint_name, violations)")
                         .withColumn("table_name", F.lit(r.name)))
        for key in r.unique:
            dup = (r.df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
                   .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations")))
            parts.append(dup.select(F.lit(f"unique:{','.join(key)}").alias("constraint_name"),
                                    "violations", F.lit(r.name).alias("table_name")))
    if not parts:
        return SparkSession.active().createDataFrame([], REPORT)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("table_name", "constraint_name", F.col("violations").cast("long").alias("violations"))


def require_key(df: DataFrame, key: str, name: str) -> None:
    """Raise unless ``key`` is unique and not null in ``df``."""
    enforce([TableRules(name, df, not_null=[key], unique=[[key]])])


class ConstraintViolation(Exception):
    pass


def enforce(rules: list[TableRules]) -> None:
    """Raise :class:`ConstraintViolation` listing every broken rule (fail mode)."""
    broken = validate(rules).where(F.col("violations") > 0).collect()  # one row per rule at most
    if broken:
        raise ConstraintViolation("; ".join(f"{r.table_name}.{r.constraint_name}: {r.violations}"
                                            for r in broken))
