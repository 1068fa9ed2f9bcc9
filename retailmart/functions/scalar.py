"""Scalar Column helpers.

All of them are built-in Spark expressions, so they stay inside whole-stage codegen.
Engine differences that matter for exact results (SURVEY §1.4) are decided here once:
integer averages truncate, money stays decimal, ratios are NULL on a zero base.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Fixed values ------------------------------------------------------------------------
# Fallback conversion rate BRL -> INR used when no rate is available.
FALLBACK_RATE = Decimal("18.5")
# Job-step status codes and their names.
RUN_STATUS_NAMES = {0: "Failed", 1: "Succeeded", 2: "Retry", 3: "Cancelled", 4: "In Progress"}
# Customer segments (name, minimum distinct orders, minimum lifetime value), checked in order;
# anything else is 'One-Time'.
DEFAULT_SEGMENTS = (("VIP", 5, Decimal("50000")), ("Loyal", 3, Decimal("20000")), ("Returning", 2, None))
DEFAULT_AS_OF = _dt.date(2018, 12, 31)


# Types -------------------------------------------------------------------------------
def ts_ntz(value: _dt.datetime) -> Column:
    """A wall-clock TIMESTAMP_NTZ literal, independent of process and session time zones."""
    return F.make_timestamp_ntz(F.lit(value.year), F.lit(value.month), F.lit(value.day), F.lit(value.hour),
                                F.lit(value.minute), F.lit(Decimal(value.second) + Decimal(value.microsecond)
                                                           / Decimal(1_000_000)).cast("decimal(8,6)"))


def to_timestamp_any(c: ColumnOrName, dtype: str) -> Column:
    """Timestamp from a staging column: strings are parsed leniently (bad -> NULL)."""
    col = _c(c)
    if dtype == "string":
        return F.try_to_timestamp(col).cast("timestamp_ntz")
    if dtype == "date":
        return col.cast("timestamp_ntz")
    return col


def date_key(c: ColumnOrName) -> Column:
    """Integer date key yyyyMMdd of a date or timestamp (arithmetic, no string formatting)."""
    d = F.to_date(_c(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def year_of_date_key(c: ColumnOrName) -> Column:
    """Year encoded in a yyyyMMdd key (key div 10000)."""
    return F.call_function("div", _c(c), F.lit(10000)).cast("int")


def date_key_range(c: ColumnOrName, year: int) -> Column:
    """Sargable form of ``year(key) = year``: a BETWEEN on the key itself."""
    return _c(c).between(year * 10000 + 101, year * 10000 + 1231)


def currency_convert(amount: ColumnOrName, rate: Decimal | Column, scale: int = 2,
                     precision: int = 12) -> Column:
    """round(amount * rate, 2) as decimal(12,2); the rate is a decimal, never a double."""
    r = rate if isinstance(rate, Column) else F.lit(Decimal(rate))
    return F.round(_c(amount) * r, scale).cast(f"decimal({precision},{scale})")


def null_default(c: ColumnOrName, default) -> Column:
    """ISNULL(c, default)."""
    return F.coalesce(_c(c), F.lit(default))


def delivery_days(delivered: ColumnOrName, purchased: ColumnOrName) -> Column:
    """Calendar days from purchase to delivery; NULL while not delivered."""
    d, p = _c(delivered), _c(purchased)
    return F.when(d.isNotNull(), F.datediff(F.to_date(d), F.to_date(p)))


def late_flag(delivered: ColumnOrName, estimated: ColumnOrName) -> Column:
    """1 when delivered after the estimate, else 0 (NULLs give 0)."""
    return F.when(_c(delivered) > _c(estimated), F.lit(1)).otherwise(F.lit(0))


def segment_case(order_count: ColumnOrName, lifetime_value: ColumnOrName,
                 segments=DEFAULT_SEGMENTS, default: str = "One-Time") -> Column:
    """Ordered CASE over (name, min orders, min value) tiers."""
    oc, lv = _c(order_count), _c(lifetime_value)
    expr = None
    for name, min_orders, min_value in segments:
        cond = oc >= min_orders
        if min_value is not None:
            cond = cond & (lv >= F.lit(Decimal(min_value)))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def recency_days(last_date: ColumnOrName, as_of: _dt.date = DEFAULT_AS_OF) -> Column:
    """Days from the last order to a fixed as-of date (a parameter, never 'today')."""
    return F.datediff(F.lit(as_of), _c(last_date))


def status_decode(c: ColumnOrName, names: dict[int, str] = RUN_STATUS_NAMES) -> Column:
    """Status code -> name; unknown codes give NULL."""
    col, expr = _c(c), None
    for code, name in names.items():
        expr = F.when(col == code, F.lit(name)) if expr is None else expr.when(col == code, F.lit(name))
    return expr


def calendar_fields(d: ColumnOrName) -> dict[str, Column]:
    """The calendar attributes of a date, by output name."""
    col = _c(d)
    return {
        "date_sk": date_key(col),
        "full_date": col,
        "day": F.dayofmonth(col),
        "month": F.month(col),
        "month_name": F.date_format(col, "MMMM"),
        "quarter": F.quarter(col),
        "year": F.year(col),
        "is_weekend": F.when(F.weekday(col) >= 5, 1).otherwise(0),
        "day_of_week": F.date_format(col, "EEEE"),
    }


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den, NULL when the base is zero or NULL."""
    return F.try_divide(_c(num), F.nullif(_c(den), F.lit(0)))


def growth_pct(cur: ColumnOrName, prev: ColumnOrName, scale: int = 2, money_scale: int = 2) -> Column:
    """round((cur - prev) / prev * 100, 2) on decimal money, NULL on a zero base (double)."""
    c, p = _c(cur), _c(prev)
    return ratio_half_up((c - p) * 100, p, scale, num_scale=money_scale, den_scale=money_scale)


def _half_up_quotient(num: Column, den: Column, scale: int, num_scale: int, den_scale: int) -> Column:
    """Unscaled HALF_UP quotient q = round(num / den * 10^scale) using integer division only."""
    n = (num * F.lit(Decimal(10) ** num_scale)).cast("decimal(38,0)") * F.lit(Decimal(10) ** (den_scale + scale))
    d = (den * F.lit(Decimal(10) ** den_scale)).cast("decimal(38,0)") * F.lit(Decimal(10) ** num_scale)
    n, d = n.cast("decimal(38,0)"), d.cast("decimal(38,0)")
    two = F.lit(Decimal(2))
    mag = F.call_function("div", F.abs(n) * two + F.abs(d), F.abs(d) * two)
    neg = (n < 0) != (d < 0)
    return F.when(d != 0, F.when(neg & (n != 0), -mag).otherwise(mag))


def ratio_half_up(num: ColumnOrName, den: ColumnOrName, scale: int = 2, num_scale: int = 0,
                  den_scale: int = 0) -> Column:
    """Exact ``round(num / den, scale)`` with HALF_UP (away from zero), returned as double.

    ``num`` / ``den`` are integral, or decimals with ``num_scale`` / ``den_scale`` digits.
    The quotient is formed by integer division of the unscaled values, so nothing is
    rounded twice (a decimal division would first round at its own result scale).
    NULL when ``den`` is 0 or NULL.
    """
    q = _half_up_quotient(_c(num), _c(den), scale, num_scale, den_scale)
    return q.cast("double") / F.lit(float(10 ** scale))


def ratio_half_up_decimal(num: ColumnOrName, den: ColumnOrName, scale: int = 2, num_scale: int = 0,
                          den_scale: int = 0) -> Column:
    """Same as ``ratio_half_up`` but kept as decimal(38, scale) for further exact math."""
    q = _half_up_quotient(_c(num), _c(den), scale, num_scale, den_scale)
    return (q.cast("decimal(38,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal(38,{scale})")


def pct_decimal(part: ColumnOrName, total: ColumnOrName, scale: int = 2) -> Column:
    """round(part * 100.0 / total, 2) for integer counts (exact HALF_UP), as double."""
    return ratio_half_up(_c(part) * 100, total, scale)


def int_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """a div b (integer division, truncating toward zero); NULL when b is 0 or NULL."""
    bb = _c(b)
    return F.call_function("div", _c(a), F.nullif(bb, F.lit(0)))


def int_pct_truncated(part: ColumnOrName, total: ColumnOrName) -> Column:
    """Integer-truncated percentage: part * 100 div total (T-SQL int / int)."""
    return int_div(_c(part).cast("long") * 100, _c(total).cast("long"))


def avg_int_truncated(total: ColumnOrName, count: ColumnOrName) -> Column:
    """T-SQL AVG of an int column: sum div count (truncating), NULL for no values."""
    return int_div(_c(total).cast("long"), _c(count).cast("long")).cast("int")


def format_timestamp(c: ColumnOrName) -> Column:
    """ISO text 'yyyy-MM-dd HH:mm:ss' (style 120)."""
    return F.date_format(_c(c), "yyyy-MM-dd HH:mm:ss")


def run_id_label(ts: _dt.datetime) -> str:
    """'DQ_yyyyMMdd_HHmmss' for a run started at ``ts`` (fixed once per run)."""
    return "DQ_" + ts.strftime("%Y%m%d_%H%M%S")


def run_id_of(ts: ColumnOrName) -> Column:
    """Column form of ``run_id_label``: 'DQ_yyyyMMdd_HHmmss' of a timestamp column."""
    return F.concat(F.lit("DQ_"), F.date_format(_c(ts), "yyyyMMdd_HHmmss"))


def stored_id(ts: ColumnOrName, seq: ColumnOrName) -> Column:
    """Id of row ``seq`` of the run at ``ts``: unique over appended runs, as a run id holds its
    second and a run has under a million rows.  Wall-clock arithmetic: no time zone is involved."""
    t = _c(ts)
    days = F.datediff(F.to_date(t), F.lit(_dt.date(1970, 1, 1))).cast("long")
    seconds = days * 86400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    return seconds * 1_000_000 + _c(seq).cast("long")


def number_label(n: ColumnOrName, suffix: str) -> Column:
    """'1,234 <suffix>' with thousands separators."""
    return F.concat(F.format_number(_c(n).cast("long"), 0), F.lit(suffix))


def concat_alert_line(table: ColumnOrName, column: ColumnOrName, rule: ColumnOrName,
                      failed: ColumnOrName, pct: ColumnOrName) -> Column:
    """'Table: t | Column: c | Rule: r | Failed Rows: n | Failure %: p' (NULL parts read as '')."""
    # The label texts of an alert line.
    labels = ["Table: ", " | Column: ", " | Rule: ", " | Failed Rows: ", " | Failure %: "]
    parts = []
    for label, value in zip(labels, [table, column, rule, failed, pct]):
        parts += [F.lit(label), F.coalesce(_c(value).cast("string"), F.lit(""))]
    return F.concat(*parts)


def text_prefix(c: ColumnOrName, n: int = 80) -> Column:
    return F.substring(_c(c), 1, n)
