"""Column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    """A condition or value given as a Column or as SQL text."""
    return F.expr(value) if isinstance(value, str) else value


def is_true(condition: ColumnLike) -> Column:
    """NULL counts as false: an unknown outcome never satisfies a rule."""
    return F.coalesce(as_column(condition), F.lit(False))


def clean_text(value: Column, case: str = "lower") -> Column:
    trimmed = F.trim(value)
    if case == "lower":
        return F.lower(trimmed)
    if case == "upper":
        return F.upper(trimmed)
    return trimmed


def key_hash(parts: Sequence[str | Column], separator: str = "|", null_token: str | None = "␀") -> Column:
    """SHA-256 over the joined parts.

    `concat_ws` skips NULLs, which makes ('a', NULL) equal to ('a'); a NULL part
    is therefore replaced by `null_token`. Pass None to keep the plain form.
    Rows without NULLs hash the same either way.
    """
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    if null_token is not None:
        texts = [F.coalesce(t, F.lit(null_token)) for t in texts]
    return F.sha2(F.concat_ws(separator, *texts), 256)


def mask_tail(value: Column, keep: int = 4, prefix: str = "****-****-****-") -> Column:
    return F.concat(F.lit(prefix), F.right(value, F.lit(keep)))


def safe_ratio(numerator: Column, denominator: Column, factor: int = 1) -> Column:
    """numerator / denominator * factor, NULL where the denominator is zero."""
    return numerator / F.nullif(denominator, F.lit(0)) * factor


def percent_change(current: Column, previous: Column, scale: int = 2) -> Column:
    return F.when(
        previous.isNotNull() & (previous != 0),
        F.round((current - previous) / previous * 100, scale),
    )
