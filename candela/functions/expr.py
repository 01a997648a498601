"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(c) -> Column:
    """NaN → NULL, so that averages skip it the way pandas does."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nanvl(c, F.lit(None).cast("double"))


def valid_price(c) -> Column:
    """A quote exists: the price is neither NULL nor NaN."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & ~F.isnan(c)


def split_tickers(text: str) -> list[str]:
    """Comma-separated ticker list → names, blanks removed (CLI argument)."""
    return [t.strip() for t in (text or "").split(",") if t.strip()]


def as_list(tickers) -> list[str]:
    """A ticker argument as a list: one name is a list of one, never its letters."""
    return [tickers] if isinstance(tickers, str) else list(tickers)


def py_isoformat(ts) -> Column:
    """Python ``datetime.isoformat()`` text of a zone-less timestamp.

    Microseconds are printed only when non-zero, as Python does.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.when(F.date_format(ts, "SSSSSS") == "000000",
                  F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")) \
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def iso_utc(ts) -> Column:
    """``utcnow().isoformat() + 'Z'`` form: always six fraction digits."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
