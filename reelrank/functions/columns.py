"""Column expressions shared by the operators. All are Catalyst built-ins (codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns of the lenient parser: an integer is digits with an optional sign and
# nothing else (no blanks); a float additionally allows a fraction, an exponent, nan, inf.
INT_PATTERN = r"^[+-]?[0-9]+$"
FLOAT_PATTERN = (r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
                 r"|(?i:nan|inf|infinity))$")
DATE_PATTERN = "yyyy-M-d"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a, b) -> Column:
    """Per-row dot product of two equal-length ARRAY<DOUBLE> columns, summed left to right."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0),
                       lambda s, x: s + x)


def clip(c, lo: float, hi: float) -> Column:
    return F.least(F.greatest(_c(c), F.lit(float(lo))), F.lit(float(hi)))


def lenient_int(s, dtype: str = "int") -> Column:
    """String → integer, NULL for anything that is not a plain signed integer or overflows."""
    s = _c(s)
    return F.when(s.rlike(INT_PATTERN), s.try_cast(dtype))


def lenient_float(s, dtype: str = "float") -> Column:
    s = _c(s)
    return F.when(s.rlike(FLOAT_PATTERN), s.try_cast(dtype))


def lenient_date(s) -> Column:
    """``%Y-%m-%d`` parse; NULL on failure (never accepts a bare year or blanks)."""
    s = _c(s)
    return F.when(s.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"),
                  F.try_to_date(s, DATE_PATTERN))


def hash_key(*cols, seed: int) -> Column:
    """Seeded, engine-independent pseudo-random order key: md5 of 'a:b:...:seed'."""
    parts = [_c(c).cast("string") for c in cols] + [F.lit(str(seed))]
    return F.md5(F.concat_ws(":", *parts))


def rmse(err) -> Column:
    e = _c(err)
    return F.sqrt(F.avg(e * e))


def rounded(c, digits: int = 6) -> Column:
    return F.round(_c(c), digits)
