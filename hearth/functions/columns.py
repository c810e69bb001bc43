"""Row-local column functions (Column -> Column), all JVM-side built-ins.

ANSI mode stays on: divisions use ``try_divide`` and text goes through
``try_cast`` so bad input becomes NULL instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clip(x: ColumnOrName, lo: float | None = None, hi: float | None = None) -> Column:
    """pandas ``clip``: bounds applied, NULL stays NULL (``greatest`` alone would drop it)."""
    x = _c(x)
    y = x
    if lo is not None:
        y = F.greatest(y, F.lit(lo))
    if hi is not None:
        y = F.least(y, F.lit(hi))
    return F.when(x.isNotNull(), y)


def finite(x: ColumnOrName) -> Column:
    """NaN and infinities → NULL."""
    x = _c(x)
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def to_number(x: ColumnOrName) -> Column:
    """Text or number to double; unparsable, NaN and infinite values become NULL (``to_numeric(errors='coerce')``).

    Numbers are cast directly; the cast of text ignores surrounding white space.
    """
    return finite(_c(x).try_cast("double"))


def to_int(x: ColumnOrName, bits: int = 32) -> Column:
    """Number to integer by truncation toward zero; out of range → NULL.

    Never cast text straight to int (``'3.6'`` would become NULL): go through double.
    """
    d = to_number(x)
    lim = float(2 ** (bits - 1))
    t = F.when((d >= -lim) & (d < lim), F.when(d >= 0, F.floor(d)).otherwise(F.ceil(d)))
    return t.cast("int" if bits <= 32 else "bigint")


def excel_date(serial: ColumnOrName) -> Column:
    """Excel serial day number (number or text, a fraction is the time of day) → date (epoch 1899-12-30); bad text → NULL."""
    return F.date_add(F.lit("1899-12-30").cast("date"), to_int(serial))


def parse_ts(x: ColumnOrName, fmt: str = "yyyyMMdd'T'HHmmss") -> Column:
    """Parse text by pattern; unparsable → NULL (``errors='coerce'``)."""
    return F.try_to_timestamp(_c(x), F.lit(fmt)).cast("timestamp_ntz")


def code_map(x: ColumnOrName, mapping: Mapping[str, int], default: int) -> Column:
    """Text → code through a fixed map, anything else (and NULL) → default."""
    x = _c(x)
    e = None
    for k, v in mapping.items():
        e = F.when(x == k, F.lit(v)) if e is None else e.when(x == k, F.lit(v))
    return e.otherwise(F.lit(default))


# Second-market text codes (waterfront N/Y; condition words 1..5).
WATERFRONT_CODES = {"N": 0, "Y": 1}
CONDITION_CODES = {"Poor": 1, "Fair": 2, "Average": 3, "Good": 4, "Very Good": 5}


# ----------------------------------------------------------- engineered features

def property_age(sale_year: ColumnOrName = "sale_year", yr_built: ColumnOrName = "yr_built") -> Column:
    """max(sale_year − yr_built, 0); NULL input stays NULL."""
    return clip(_c(sale_year) - _c(yr_built), 0)


def has_renovated(yr_renovated: ColumnOrName = "yr_renovated") -> Column:
    """1 if renovated (year > 0) else 0; NULL counts as not renovated."""
    return F.when(_c(yr_renovated) > 0, 1).otherwise(0)


def years_since_renovation(sale_year: ColumnOrName = "sale_year",
                           yr_renovated: ColumnOrName = "yr_renovated",
                           age: ColumnOrName | None = None) -> Column:
    """sale_year − yr_renovated if renovated, else the property age (0 when absent); floor 0."""
    fallback = _c(age) if age is not None else F.lit(0)
    v = F.when(_c(yr_renovated) > 0, _c(sale_year) - _c(yr_renovated)).otherwise(fallback)
    return clip(v, 0)


def basement_ratio(basement: ColumnOrName = "sqft_basement", living: ColumnOrName = "sqft_living") -> Column:
    """clip(basement / living, 0, 1); zero or missing living area → 0."""
    r = F.coalesce(F.try_divide(_c(basement), F.when(_c(living) != 0, _c(living))), F.lit(0.0))
    return F.least(F.greatest(r, F.lit(0.0)), F.lit(1.0))


def school_accessibility(schools: ColumnOrName = "schools_nearby",
                         km: ColumnOrName = "airport_distance_km") -> Column:
    """Schools / ln(1 + km); 0 km (infinite in numpy) is NULL here."""
    return F.try_divide(_c(schools), F.log1p(_c(km)))


def total_interior_area(above: ColumnOrName = "sqft_above", basement: ColumnOrName = "sqft_basement") -> Column:
    """B17."""
    return _c(above) + _c(basement)


def grade_condition_score(grade: ColumnOrName = "grade", condition: ColumnOrName = "condition") -> Column:
    """B18."""
    return _c(grade) * _c(condition)


def waterfront_view_premium(waterfront: ColumnOrName = "waterfront", view: ColumnOrName = "view") -> Column:
    """Waterfront × (view > 0)."""
    return _c(waterfront) * F.when(_c(view) > 0, 1).otherwise(0)


def sale_season(month: ColumnOrName = "sale_month") -> Column:
    """Meteorological season of the sale month; anything else → spring."""
    m = _c(month)
    return (F.when(m.isin(12, 1, 2), "winter").when(m.isin(3, 4, 5), "spring")
             .when(m.isin(6, 7, 8), "summer").when(m.isin(9, 10, 11), "fall")
             .otherwise("spring"))


def sqft_above_from(living: ColumnOrName = "sqft_living", basement: ColumnOrName = "sqft_basement") -> Column:
    """Above-ground area at scoring time, max(living − basement, 0)."""
    return clip(_c(living) - _c(basement), 0)


def relative_to(value: ColumnOrName, group_stat: ColumnOrName, default: ColumnOrName) -> Column:
    """Value / coalesce(group statistic, default); a zero divisor becomes 1."""
    d = F.coalesce(_c(group_stat), _c(default))
    return _c(value) / F.when(d != 0, d).otherwise(F.lit(1.0))


# ------------------------------------------------------------------- scoring

def band(pred: ColumnOrName, pct: float = 0.12) -> tuple[Column, Column]:
    """(low, high) = pred × (1 ∓ pct)."""
    return _c(pred) * (1 - pct), _c(pred) * (1 + pct)


# Weights of the rule-based valuation (per unit of each input) and its floor.
RULE_WEIGHTS = {"sqft_living": 950.0, "grade": 120000.0, "bathrooms": 85000.0, "view": 60000.0,
                "waterfront": 350000.0, "airport_distance_km": -2500.0}
RULE_FLOOR = 1200000.0


def rule_based_value(weights: Mapping[str, float] = RULE_WEIGHTS, floor: float = RULE_FLOOR) -> Column:
    """max(Σ weight·column, floor)."""
    s = None
    for k, w in weights.items():
        term = F.col(k) * w
        s = term if s is None else s + term
    return clip(s, floor)


def market_score(hpi: ColumnOrName = "latest_hpi", real: ColumnOrName = "real_price_idx",
                 nominal: ColumnOrName = "nom_price_idx", km: ColumnOrName = "airport_distance_km",
                 digits: int | None = 1) -> Column:
    """Weighted capped ratios on a 0–100 scale (round half-even like Python ``round``)."""
    # Weights .35/.30/.20/.15, scales 250/150/180, caps 1.2, distance scale 30 km.
    s = (0.35 * F.least(_c(hpi) / 250, F.lit(1.2))
         + 0.30 * F.least(_c(real) / 150, F.lit(1.2))
         + 0.20 * F.least(_c(nominal) / 180, F.lit(1.2))
         + 0.15 * F.least((4 - F.least(_c(km) / 30, F.lit(4.0))) / 4 + 0.2, F.lit(1.0)))
    v = s * 100
    return F.bround(v, digits) if digits is not None else v


def risk_band(pred: ColumnOrName, lo: ColumnOrName, hi: ColumnOrName,
              cuts: tuple[float, float] = (0.20, 0.28)) -> Column:
    """Relative spread (hi − lo) / max(pred, 1) → Low / Moderate / Elevated."""
    spread = (_c(hi) - _c(lo)) / F.greatest(_c(pred), F.lit(1.0))
    return F.when(spread <= cuts[0], "Low").when(spread <= cuts[1], "Moderate").otherwise("Elevated")
