"""Units of measure, time zones, FX rounding and exact decimal helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(c, p: int, s: int) -> Column:
    return _col(c).cast(f"decimal({p},{s})")


def to_base_uom(qty, uom, factor, box: str = "BOX") -> Column:
    """Quantity in each (EA): BOX quantities times the pack factor."""
    return F.when(_col(uom) == box, _col(qty) * _col(factor)).otherwise(_col(qty)).cast("decimal(18,3)")


def local_to_utc(ts_local, zone) -> Column:
    return F.convert_timezone(_col(zone), F.lit("UTC"), _col(ts_local))


def utc_to_local(ts_utc, zone) -> Column:
    return F.convert_timezone(F.lit("UTC"), _col(zone), _col(ts_utc))


def hours_between(a, b) -> Column:
    """Hour boundaries crossed from ``a`` to ``b`` (02:45 -> 05:00 is 3).

    Pure wall-clock arithmetic on TIMESTAMP_NTZ fields (days x 24 + hour
    difference), so the result never depends on the session time zone."""
    ca, cb = _col(a), _col(b)
    return (F.datediff(F.to_date(cb), F.to_date(ca)).cast("bigint") * 24
            + F.hour(cb).cast("bigint") - F.hour(ca).cast("bigint"))


def hours_to_days_2dp(hours) -> Column:
    """round(hours / 24, 2) half-up, computed exactly in integers and returned
    as DECIMAL(18,2) (hours >= 0)."""
    h = _col(hours).cast("bigint")
    cents = (h * 100 + 12).cast("bigint")
    return (F.floor(cents / F.lit(24)).cast("decimal(18,0)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(18,2)")


def round_div_4dp(numer_2dp, denom_int) -> Column:
    """round(x / n, 4) half-up for x >= 0 with 2 decimals and integer n > 0,
    exact: (cents * 100 * 2 + n) div (2n) ten-thousandths."""
    cents = (_col(numer_2dp) * 100).cast("bigint")
    n = _col(denom_int).cast("bigint") if not isinstance(denom_int, int) else F.lit(denom_int).cast("bigint")
    tenk = F.floor((cents * 200 + n) / (n * 2)).cast("decimal(18,0)")
    return (tenk * F.lit(0.0001).cast("decimal(5,4)")).cast("decimal(18,4)")


def ratio(num, den) -> Column:
    """num / den as DOUBLE, null when den is 0 or null (sums cast to double first)."""
    d = _col(den).cast("double")
    return F.when(d == 0, F.lit(None).cast("double")).otherwise(_col(num).cast("double") / d)
