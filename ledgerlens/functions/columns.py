"""Scalar building blocks.  Each returns a ``Column`` and stays inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.schema import EVENT_SYNONYMS

__all__ = [
    "standardize_address", "parse_timestamp", "normalize_event_type", "coerce_amount",
    "day_diff", "guarded_ratio", "safe_corr", "round_half_even_int", "sigmoid",
    "ts_literal", "epoch_micros", "chunk_of",
]

_MICROS_PER_DAY = 86400e6


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def standardize_address(c) -> Column:
    """Drop one leading lower-case ``0x`` and lower-case the rest."""
    return F.lower(F.regexp_replace(_c(c), "^0x", ""))


def parse_timestamp(c) -> Column:
    """Epoch seconds (number or numeric string) else a parseable date string.

    Decided per row; a value that is neither becomes NULL (and is later dropped
    as a row without timestamp).
    """
    s = _c(c).cast("string")
    exact = s.try_cast("decimal(38,9)")        # keeps every microsecond digit
    approx = s.try_cast("double")              # exponent notation
    return F.coalesce(F.timestamp_seconds(exact), F.timestamp_seconds(approx), F.try_to_timestamp(s))


def normalize_event_type(c) -> Column:
    """Strip whitespace, title-case, then map synonyms to canonical names."""
    titled = F.initcap(F.regexp_replace(_c(c), r"^\s+|\s+$", ""))
    mapping = F.create_map(*[F.lit(x) for kv in EVENT_SYNONYMS.items() for x in kv])
    return F.coalesce(F.try_element_at(mapping, titled), titled)


def coerce_amount(c) -> Column:
    """Numeric coercion; unparseable values become NULL (never an error)."""
    return _c(c).try_cast("double")


def epoch_micros(c) -> Column:
    col = _c(c)
    return F.unix_micros(col.cast("timestamp"))


def day_diff(start, end) -> Column:
    """Fractional days from ``start`` to ``end``."""
    return (epoch_micros(end) - epoch_micros(start)) / F.lit(_MICROS_PER_DAY)


def guarded_ratio(x, y) -> Column:
    """``x / max(1, y)``."""
    return _c(x) / F.greatest(F.lit(1.0), _c(y).cast("double"))


def safe_corr(a, b) -> Column:
    """Pearson correlation; NULL when either side is constant (no error)."""
    a, b = _c(a).cast("double"), _c(b).cast("double")
    return F.try_divide(F.covar_pop(a, b), F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0)))


def round_half_even_int(x, lo: int = 0, hi: int = 100) -> Column:
    """Round half to even, then clip to [lo, hi], as int."""
    return F.least(F.lit(hi), F.greatest(F.lit(lo), F.bround(_c(x), 0).cast("int")))


def sigmoid(x, k: float = 1.0, x0: float = 0.0) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-k) * (_c(x) - F.lit(x0))))


def ts_literal(dt) -> Column:
    """A timestamp literal in the session zone (UTC)."""
    return F.lit(dt.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def chunk_of(ts, width_seconds: int) -> Column:
    """Time chunk index used to split one wallet's timeline over tasks."""
    return F.floor(epoch_micros(ts) / F.lit(width_seconds * 1_000_000)).cast("long")
