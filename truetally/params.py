"""Governed metric parameters (the rules a definition change may touch)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace
from decimal import Decimal

# "Today" is always explicit. The driver tables end in 2001; this date makes
# the last complete calendar quarter 1999-10-01 .. 1999-12-31.
DEFAULT_AS_OF = dt.date(2000, 1, 15)

# Fixed values (must equal the reference): parameter names, seed values,
# allowed ranges, versions and the metric each one feeds.
EARLY = "SUPPLIER_OTD_EARLY_TOLERANCE_DAYS"
LATE = "SUPPLIER_OTD_LATE_TOLERANCE_DAYS"
DOI_WINDOW = "DOI_COGS_WINDOW_DAYS"
INSURANCE = "INSURANCE_RATE_PCT"

PARAM_SEED = [
    # name, value, unit, used_by, version, min, max
    (EARLY, Decimal("3"), "days", "supplier_otd", "1.2", Decimal("0"), Decimal("10")),
    (LATE, Decimal("2"), "days", "supplier_otd", "1.2", Decimal("0"), Decimal("10")),
    (DOI_WINDOW, Decimal("90"), "days", "days_of_inventory", "1.0", Decimal("30"), Decimal("365")),
    (INSURANCE, Decimal("0.5"), "% of goods value", "total_landed_cost_usd", "1.1", Decimal("0"), Decimal("5")),
]

PARAM_DESCRIPTIONS = {
    EARLY: "Full quantity arriving up to N days before the confirmed date is on time",
    LATE: "Full quantity arriving up to N days after the confirmed date is on time",
    DOI_WINDOW: "Trailing window of average daily COGS",
    INSURANCE: "Cargo insurance as a percentage of goods value",
}


@dataclass(frozen=True)
class ParamRow:
    name: str
    value: Decimal
    unit: str
    used_by: str
    version: str
    min_value: Decimal
    max_value: Decimal
    updated_at: dt.datetime | None = None

    @property
    def whole_number(self) -> bool:
        # the rule is "name ends with _DAYS" (literal underscore)
        return self.name.endswith("_DAYS")


@dataclass(frozen=True)
class Params:
    """Immutable parameter set; a governed change returns a new instance."""

    rows: tuple[ParamRow, ...] = field(default_factory=lambda: tuple(
        ParamRow(n, v, u, m, ver, lo, hi) for n, v, u, m, ver, lo, hi in PARAM_SEED))

    def row(self, name: str) -> ParamRow | None:
        return next((r for r in self.rows if r.name == name), None)

    def value(self, name: str) -> Decimal:
        r = self.row(name)
        if r is None:
            raise KeyError(name)
        return r.value

    @property
    def early_tol(self) -> int:
        return int(self.value(EARLY))

    @property
    def late_tol(self) -> int:
        return int(self.value(LATE))

    @property
    def doi_window(self) -> int:
        return int(self.value(DOI_WINDOW))

    @property
    def insurance_pct(self) -> Decimal:
        return self.value(INSURANCE)

    def with_value(self, name: str, value: Decimal, version: str,
                   updated_at: dt.datetime | None = None) -> "Params":
        return Params(tuple(replace(r, value=value, version=version, updated_at=updated_at)
                            if r.name == name else r for r in self.rows))

    def to_df(self, spark):
        """METRIC_PARAMETER as a DataFrame (name, value, unit, used_by, ...)."""
        from truetally.sources.schemas import PARAM_SCHEMA
        data = [(r.name, r.value, r.unit, r.used_by, PARAM_DESCRIPTIONS.get(r.name), r.version,
                 r.updated_at, r.min_value, r.max_value, r.whole_number) for r in self.rows]
        return spark.createDataFrame(data, PARAM_SCHEMA)


def version_bump(version: str) -> str:
    """``major.(minor+1)``: 1.9 -> 1.10 (numeric, not lexical)."""
    major, minor = version.split(".")[:2]
    return f"{major}.{int(minor) + 1}"


def params_wide(param_df):
    """One row, one column per parameter: MAX(IFF(name = ..., value, NULL))
    (the conditional-max pivot the rule re-apply reads)."""
    from pyspark.sql import functions as F
    cols = {"early_tol": EARLY, "late_tol": LATE, "doi_window": DOI_WINDOW, "insurance_pct": INSURANCE}
    return param_df.agg(*[F.max(F.when(F.col("param_name") == n, F.col("param_value"))).alias(a)
                          for a, n in cols.items()])
