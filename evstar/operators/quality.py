"""Data-quality checks (Q-UNIQ, Q-NN, Q-REL, Q-ACC, Q-RNG, Q-SQL, F14).

Every check returns the violating rows as a lazy DataFrame; zero rows means
pass. Grouped checks aggregate partially in each map task before their one
shuffle, so a hot value costs one row per task, and none collects a group
anywhere: ``failures()`` is a single distributed count/sum.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import missing_parents


@dataclass(frozen=True)
class Violations:
    """Violating rows of one check.

    ``weight`` names a column holding how many input records each row
    stands for (grouped output); ``failures`` is then its sum, else the
    row count.
    """

    name: str
    rows: DataFrame
    weight: str | None = None

    def failures(self) -> int:
        if self.weight is None:
            return self.rows.count()
        total = self.rows.agg(F.sum(self.weight).alias("n")).first()["n"]
        return int(total or 0)

    def failures_frame(self) -> DataFrame:
        """One row ``(check, failures)`` computed on the cluster."""
        value = F.sum(self.weight) if self.weight else F.count(F.lit(1))
        return self.rows.agg(F.coalesce(value, F.lit(0)).cast("long").alias("failures")).select(
            F.lit(self.name).alias("check"), "failures"
        )


def _name(kind: str, cols: Sequence[str]) -> str:
    return f"{kind}({', '.join(cols)})"


def _all_present(cols: Sequence[str]) -> Column:
    cond = F.col(cols[0]).isNotNull()
    for c in cols[1:]:
        cond = cond & F.col(c).isNotNull()
    return cond


def unique(df: DataFrame, *cols: str, name: str | None = None) -> Violations:
    """Key values occurring more than once, with ``n_records``; keys with a NULL part are skipped."""
    if not cols:
        raise ValueError("unique needs at least one column")
    rows = (
        df.filter(_all_present(cols))
        .groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )
    return Violations(name or _name("unique", cols), rows)


def not_null(df: DataFrame, col: str, name: str | None = None) -> Violations:
    """Rows whose ``col`` is NULL."""
    return Violations(name or _name("not_null", [col]), df.filter(F.col(col).isNull()))


def relationships(child: DataFrame, col: str, parent: DataFrame, field: str, name: str | None = None) -> Violations:
    """Child values with no parent (NULL children pass); weighted by row count."""
    rows = missing_parents(child, col, parent, field)
    return Violations(name or f"relationships({col} -> {field})", rows, weight="n_records")


def accepted_values(df: DataFrame, col: str, values: Sequence[object], name: str | None = None) -> Violations:
    """Values outside ``values`` with ``n_records``; NULL passes."""
    rows = (
        df.groupBy(F.col(col).alias(col))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(~F.col(col).isin(list(values)))
    )
    return Violations(name or _name("accepted_values", [col]), rows)


def range_violation(
    col: str, min_value: object | None = None, max_value: object | None = None, inclusive: bool = True
) -> Column:
    """Row condition: ``col`` outside the range. NULL (unknown) for a NULL value, so it passes."""
    if min_value is None and max_value is None:
        raise ValueError("accepted_range needs min_value or max_value")
    c = F.col(col)
    ok: Column = F.lit(True)
    if min_value is not None:
        ok = ok & ((c >= F.lit(min_value)) if inclusive else (c > F.lit(min_value)))
    if max_value is not None:
        ok = ok & ((c <= F.lit(max_value)) if inclusive else (c < F.lit(max_value)))
    return ~ok


def accepted_range(
    df: DataFrame,
    col: str,
    min_value: object | None = None,
    max_value: object | None = None,
    inclusive: bool = True,
    name: str | None = None,
) -> Violations:
    """Rows outside ``[min, max]`` (or the open interval); NULL passes."""
    return Violations(name or _name("accepted_range", [col]), df.filter(range_violation(col, min_value, max_value, inclusive)))


def singular(name: str, rows: DataFrame, weight: str | None = None) -> Violations:
    """A hand-written check: ``rows`` already holds its violations."""
    return Violations(name, rows, weight)


def total_violation(
    total: str = "total_amount", quantity: str = "quantity", unit_price: str = "unit_price", tolerance: str = "0.01"
) -> Column:
    """Row condition of :func:`total_mismatch`; NULL when an operand is NULL."""
    diff = F.abs(F.col(total) - F.col(quantity) * F.col(unit_price))
    return diff > F.lit(tolerance).cast("decimal(10,2)")


def total_mismatch(
    df: DataFrame,
    total: str = "total_amount",
    quantity: str = "quantity",
    unit_price: str = "unit_price",
    tolerance: str = "0.01",
    keep: Sequence[str] = ("order_id", "quantity", "unit_price", "total_amount"),
) -> DataFrame:
    """Rows where ``total`` differs from ``quantity * unit_price`` by more than
    ``tolerance`` (F14). Decimal arithmetic; a NULL operand passes."""
    return df.filter(total_violation(total, quantity, unit_price, tolerance)).select(*keep)
