"""Split-test Column functions (B7-B10): the branch index a row takes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def numeric_test(v, value: float, equal_test: bool = False) -> Column:
    """Branch 0 if ``v < value`` (or ``v == value`` for the equality test), else 1."""
    cond = (_c(v) == F.lit(value)) if equal_test else (_c(v) < F.lit(value))
    return F.when(cond, F.lit(0)).otherwise(F.lit(1))


def nominal_test(v, value) -> Column:
    """Branch 0 if ``v == value`` else 1."""
    return F.when(_c(v) == F.lit(value), F.lit(0)).otherwise(F.lit(1))


def multiway_test(v) -> Column:
    """branch = the (coded) value itself."""
    return _c(v).cast("int")


def rule_predicate(v, value: float, operator: int) -> Column:
    """Operator 0 ``==``, 1 ``<=``, 2 ``<``, anything else ``==``; 0 if it holds."""
    v = _c(v)
    cond = {1: v <= F.lit(value), 2: v < F.lit(value)}.get(operator, v == F.lit(value))
    return F.when(cond, F.lit(0)).otherwise(F.lit(1))


def rule_description(feature: int, value: float, operator: int) -> tuple[str, str]:
    ops = ("==", "!=") if operator not in (1, 2) else (("<=", ">") if operator == 1 else ("<", ">="))
    return (f"[feature {feature} numeric 0] {ops[0]} {value}",
            f"[feature {feature} numeric 1] {ops[1]} {value}")
