"""Declarative data-quality rules.

A rule is a small frozen object; it knows its audit labels (column, rule name, rule type,
severity, threshold, details text) and how to count its failures as Spark expressions.
Scalar rules (not-null, range, allowed values, date logic) are a ``count_if`` each and
are fused into one aggregate per table.  Uniqueness and referential-integrity rules need
a grouping of their own (``runner``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severities and rule-type labels of the audit trail.
CRITICAL, WARNING = "critical", "warning"
COMPLETENESS, UNIQUENESS, VALIDITY, INTEGRITY = "completeness", "uniqueness", "validity", "integrity"

# Comparison operators accepted by the date-logic rule.
_OPS = {
    ">=": lambda a, b: a >= b,
    ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b,
    "<": lambda a, b: a < b,
    "=": lambda a, b: a == b,
}


def _fmt(v) -> str:
    """Bound as the audit text shows it (Python's str of int/float/None)."""
    return str(v)


def _n(n: Column) -> Column:
    return F.format_number(n.cast("long"), 0)


@dataclass(frozen=True)
class Rule:
    column: str
    threshold: Decimal
    severity: str

    kind = "scalar"
    rule_type = ""

    @property
    def rule_name(self) -> str:
        raise NotImplementedError

    @property
    def column_label(self) -> str:
        return self.column

    def failing(self) -> Column:
        """Boolean Column: this row fails the rule (scalar rules only)."""
        raise NotImplementedError

    def details(self, failed: Column) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class NotNull(Rule):
    threshold: Decimal = Decimal("95.0")
    severity: str = CRITICAL
    rule_type = COMPLETENESS

    @property
    def rule_name(self) -> str:
        return "not_null"

    def failing(self) -> Column:
        return F.col(self.column).isNull()

    def details(self, failed: Column) -> Column:
        return F.concat(_n(failed), F.lit(" null values found"))


@dataclass(frozen=True)
class NoDuplicates(Rule):
    """Failed = surplus rows: sum(count - 1) over duplicated values (NULL is one value)."""
    threshold: Decimal = Decimal("100.0")
    severity: str = CRITICAL
    kind = "duplicates"
    rule_type = UNIQUENESS

    @property
    def rule_name(self) -> str:
        return "no_duplicates"

    def details(self, failed: Column) -> Column:
        return F.concat(_n(failed), F.lit(" duplicate row found"))


@dataclass(frozen=True)
class ValueRange(Rule):
    """Failed = non-NULL values below ``min_val`` or above ``max_val`` (bounds inclusive)."""
    min_val: object = None
    max_val: object = None
    threshold: Decimal = Decimal("95.0")
    severity: str = WARNING
    rule_type = VALIDITY

    @property
    def active(self) -> bool:
        return self.min_val is not None or self.max_val is not None

    @property
    def rule_name(self) -> str:
        return f"value_range({_fmt(self.min_val)}, {_fmt(self.max_val)})"

    def failing(self) -> Column:
        c = F.col(self.column)
        out = None
        if self.min_val is not None:
            out = c < F.lit(self.min_val)
        if self.max_val is not None:
            hi = c > F.lit(self.max_val)
            out = hi if out is None else (out | hi)
        return c.isNotNull() & out

    def details(self, failed: Column) -> Column:
        return F.concat(_n(failed), F.lit(f" values outside [{_fmt(self.min_val)}, {_fmt(self.max_val)}]"))


@dataclass(frozen=True)
class AllowedValues(Rule):
    """Failed = non-NULL values outside the list."""
    allowed: tuple = field(default_factory=tuple)
    threshold: Decimal = Decimal("98.0")
    severity: str = WARNING
    rule_type = VALIDITY

    @property
    def rule_name(self) -> str:
        return "allowed_values"

    def failing(self) -> Column:
        c = F.col(self.column)
        return c.isNotNull() & ~c.isin(list(self.allowed))

    def details(self, failed: Column) -> Column:
        return F.concat(_n(failed), F.lit(f" values not in {list(self.allowed)}"))


@dataclass(frozen=True)
class ReferentialIntegrity(Rule):
    """Failed = non-NULL values with no match in ``ref_table.ref_col``."""
    ref_table: str = ""
    ref_col: str = ""
    threshold: Decimal = Decimal("100.0")
    severity: str = CRITICAL
    kind = "ri"
    rule_type = INTEGRITY

    @property
    def rule_name(self) -> str:
        return f"rel_integrity -> {self.ref_table}.{self.ref_col}"

    def details(self, failed: Column) -> Column:
        return F.concat(_n(failed), F.lit(f" orphan records (no match in {self.ref_table})"))


@dataclass(frozen=True)
class DateLogic(Rule):
    """Failed = rows where both are non-NULL and NOT (column2 <op> column)."""
    column2: str = ""
    operator: str = ">="
    threshold: Decimal = Decimal("99.0")
    severity: str = WARNING
    rule_type = VALIDITY

    def __post_init__(self):
        if self.operator not in _OPS:
            raise ValueError(f"operator must be one of {sorted(_OPS)}")

    @property
    def column_label(self) -> str:
        return f"{self.column} / {self.column2}"

    @property
    def rule_name(self) -> str:
        return f"date_logic({self.column2}{self.operator}{self.column})"

    def failing(self) -> Column:
        a, b = F.col(self.column), F.col(self.column2)
        return a.isNotNull() & b.isNotNull() & ~_OPS[self.operator](b, a)

    def details(self, failed: Column) -> Column:
        return F.concat(_n(failed), F.lit(" date logic violations"))


@dataclass(frozen=True)
class TableChecks:
    """The rules to run against one table, in audit order."""
    table: str
    rules: tuple


# The suite (19 checks on the fact and two dimensions, with their thresholds) --
# Allowed order statuses (the seven intended values).
ORDER_STATUSES = ("delivered", "shipped", "canceled", "processing", "invoiced", "unavailable", "approved")


def default_suite() -> list[TableChecks]:
    d = Decimal
    return [
        TableChecks("fact_orders", (
            NotNull("order_id", d("100.0")),
            NotNull("customer_sk", d("100.0")),
            NotNull("product_sk", d("100.0")),
            NotNull("date_sk", d("100.0")),
            NotNull("price_brl", d("99.0")),
            NotNull("price_inr", d("99.0")),
            ValueRange("price_inr", min_val=0, threshold=d("99.0"), severity=CRITICAL),
            ValueRange("review_score", min_val=1, max_val=5, threshold=d("95.0"), severity=WARNING),
            ValueRange("delivery_days", min_val=0, max_val=365, threshold=d("95.0"), severity=WARNING),
            AllowedValues("order_status", allowed=ORDER_STATUSES, threshold=d("99.0")),
            ReferentialIntegrity("customer_sk", ref_table="dim_customer", ref_col="customer_sk"),
            ReferentialIntegrity("product_sk", ref_table="dim_product", ref_col="product_sk"),
            ReferentialIntegrity("seller_sk", ref_table="dim_seller", ref_col="seller_sk"),
        )),
        TableChecks("dim_customer", (
            NotNull("customer_id", d("100.0")),
            NoDuplicates("customer_id", d("100.0")),
            NotNull("state", d("95.0"), severity=WARNING),
        )),
        TableChecks("dim_product", (
            NotNull("product_id", d("100.0")),
            NoDuplicates("product_id", d("100.0")),
            ValueRange("weight_g", min_val=0, threshold=d("95.0"), severity=WARNING),
        )),
    ]
