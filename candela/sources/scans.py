"""Reading bar history.

One scan of the bar table serves every ticker, with the ticker list and date range as predicates
that Catalyst pushes into the scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.functions.expr import as_list
from candela.schemas import OHLC_FIELDS, VOLUME_FIELD, require_columns


def date_range_filter(df: DataFrame, start=None, end=None, col: str = "bar_date") -> DataFrame:
    """``start <= date < end`` (the vendor's end date is exclusive)."""
    if start is not None:
        df = df.where(F.col(col) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(col) < F.lit(end).cast("date"))
    return df


def ticker_filter(df: DataFrame, tickers, col: str = "ticker") -> DataFrame:
    """P5: ticker equality or list membership (a string is one ticker)."""
    if tickers is None:
        return df
    return df.where(F.col(col).isin(as_list(tickers)))


def close_history(bars: DataFrame, ticker: str, start=None, end=None) -> DataFrame:
    """Close series of one ticker; empty when there is nothing."""
    require_columns(bars, ["ticker", "bar_date", "close"])
    return date_range_filter(ticker_filter(bars, ticker), start, end) \
        .select("ticker", "bar_date", "close")


def ohlcv_history(bars: DataFrame, tickers, start=None, end=None,
                  include_volume: bool = False, must_exist: bool = False) -> DataFrame:
    """OHLC (and volume) columns; ``ValueError`` when one is missing, or
    (with ``must_exist``) when there is no bar at all."""
    cols = ["open", "high", "low", "close"] + (["volume"] if include_volume else [])
    require_columns(bars, ["ticker", "bar_date"] + cols)
    out = date_range_filter(ticker_filter(bars, tickers), start, end).select("ticker", "bar_date", *cols)
    return require_rows(out, ", ".join(as_list(tickers))) if must_exist else out


def stocks_view(bars: DataFrame, tickers=None, start=None, end=None) -> DataFrame:
    """The reference's combined frame ``(Date, Close, Ticker)``."""
    return date_range_filter(ticker_filter(bars, tickers), start, end) \
        .select(F.col("bar_date").alias("Date"), F.col("close").alias("Close"),
                F.col("ticker").alias("Ticker"))


def union_frames(frames) -> DataFrame:
    """Bag union by column name; an empty list raises like ``pd.concat([])``."""
    frames = list(frames)
    if not frames:
        raise ValueError("No objects to concatenate")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def requested(spark, tickers, col: str = "ticker") -> DataFrame:
    """The requested ticker list as a table ``(pos, ticker)``; pos keeps list order.

    The list is a user argument, so its size is bounded by the request.
    """
    rows = list(enumerate(as_list(tickers)))
    return spark.createDataFrame(rows, f"pos int, {col} string")


def availability(bars: DataFrame, tickers, start=None, end=None,
                 required=("open", "high", "low", "close")) -> DataFrame:
    """Per requested ticker, how many bars exist and a status.

    status: ``no_data`` when the ticker has no bar in range, ``missing_columns``
    when a required column is absent or has no value in any of its bars, else
    ``ok``.  The others are not affected by a ticker that fails.
    """
    req = requested(bars.sparkSession, tickers)
    absent = [c for c in required if c not in bars.columns]
    filled = [F.count(F.col(c)) > 0 for c in required if c in bars.columns]
    complete = reduce(lambda a, b: a & b, filled, F.lit(not absent))
    counts = (date_range_filter(ticker_filter(bars, tickers), start, end)
              .groupBy("ticker").agg(F.count(F.lit(1)).alias("n_bars"), complete.alias("complete")))
    status = F.when(F.col("n_bars").isNull(), F.lit("missing_columns" if absent else "no_data")) \
        .when(F.col("complete"), "ok").otherwise("missing_columns")
    return req.join(counts, "ticker", "left").select(
        "pos", "ticker", F.coalesce("n_bars", F.lit(0)).cast("bigint").alias("n_bars"), status.alias("status"))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """``ValueError`` where there is not a single row (reads one row at most)."""
    if df.isEmpty():
        raise ValueError(f"no rows for {what}")
    return df


def tickers_with_data(bars: DataFrame, tickers, start=None, end=None) -> DataFrame:
    """Requested tickers that have bars, with their request position."""
    # distinct first: a partial aggregate leaves one row per ticker and map task
    have = date_range_filter(ticker_filter(bars, tickers), start, end).select("ticker").distinct()
    return requested(bars.sparkSession, tickers).join(have, "ticker", "left_semi") \
        .select("pos", "ticker")


def tickers_without_data(bars: DataFrame, tickers, start=None, end=None) -> DataFrame:
    """Requested tickers without bars (reported, then skipped)."""
    have = date_range_filter(ticker_filter(bars, tickers), start, end).select("ticker").distinct()
    return requested(bars.sparkSession, tickers).join(have, "ticker", "left_anti") \
        .select("pos", "ticker")


def head_rows(stocks: DataFrame, tickers, n: int = 5) -> DataFrame:
    """G1: first n rows in union order (ticker list order, then date).

    Which rows these are is settled on tickers and dates alone, so that of bars only the keys are
    grouped; Catalyst then pushes the semi-join with the n keys (their bound is n, so they are broadcast) below
    the union and the aggregates of the bars, which read the ticks of n bars and no others.
    """
    req = requested(stocks.sparkSession, tickers, col="Ticker")
    # the request reaches the scans as a filter; the join only adds the list order
    asked = ticker_filter(stocks, tickers, "Ticker")
    first = asked.select("Ticker", "Date").join(req, "Ticker").orderBy("pos", "Date").limit(n).select("Ticker", "Date")
    return (asked.join(F.broadcast(first.distinct()), ["Ticker", "Date"], "left_semi").join(req, "Ticker")
            .orderBy("pos", "Date").limit(n)
            .select("Date", "Close", "Ticker"))


def wide_header(columns, date_col: str, sep: str, fields) -> dict:
    """``{ticker: {field: column}}`` of a wide header.

    A header cell names one field and, around it, the ticker (``None`` where
    there is only the field).  Cells without a known field are not bars.
    """
    known = {f.casefold(): f for f in fields}
    out: dict = {}
    for column in columns:
        if column == date_col:
            continue
        cells = column.split(sep)
        at = [i for i, cell in enumerate(cells) if cell.casefold() in known]
        if at:
            ticker = sep.join(cells[:at[0]] + cells[at[0] + 1:]) or None
            out.setdefault(ticker, {})[known[cells[at[0]].casefold()]] = column
    return out


def tidy_wide_bars(wide: DataFrame, date_col: str = "Date", sep: str = "|",
                   include_volume: bool = True) -> DataFrame:
    """S3: vendor wide header ``Field|TICKER`` → tidy ``(ticker, bar_date, open…)``.

    A wide row holds the bar of every ticker for its date, so the rows are
    exploded in place: no shuffle, and volume stays integral.  A ticker without
    any value on a date has no bar then; a ticker that lacks one of the four
    price columns is an error that names both.
    """
    header = wide_header(wide.columns, date_col, sep, OHLC_FIELDS + [VOLUME_FIELD])
    lacking = {t: [f for f in OHLC_FIELDS if f not in got] for t, got in header.items()}
    lacking = {t: fs for t, fs in lacking.items() if fs}
    if lacking or not header:
        raise ValueError("wide header without " + ("; ".join(
            f"{', '.join(fs)} of {t or 'its only ticker'}" for t, fs in lacking.items()) or "any price column"))
    fields = OHLC_FIELDS + ([VOLUME_FIELD] if include_volume else [])

    def cell(got: dict, field: str):
        kind = "bigint" if field == VOLUME_FIELD else "double"
        c = F.col(f"`{got[field]}`") if field in got else F.lit(None)
        return c.cast(kind).alias(field.lower())

    bars = F.array(*(F.struct(F.lit(t).cast("string").alias("ticker"), *(cell(got, f) for f in fields))
                     for t, got in header.items()))
    out = wide.select(F.col(date_col).alias("bar_date"), F.explode(bars).alias("b"))
    return out.where(F.coalesce(*(F.col(f"b.{f.lower()}").cast("double") for f in fields)).isNotNull()) \
        .select("b.ticker", "bar_date", *(f"b.{f.lower()}" for f in fields))


#: Tickers that a wide table may hold (a column for each and field).
MOST_WIDE = 2000


def all_tickers(bars: DataFrame) -> list[str]:
    """The tickers of a bar table, for a header; more than a header can hold are an error."""
    found = [r[0] for r in bars.select("ticker").distinct().where(F.col("ticker").isNotNull()).limit(MOST_WIDE + 1).collect()]
    if len(found) > MOST_WIDE:
        raise ValueError(f"more than {MOST_WIDE} tickers do not fit a wide table")
    return sorted(found)


def widen_bars(bars: DataFrame, tickers, sep: str = "|", include_volume: bool = True) -> DataFrame:
    """Inverse of :func:`tidy_wide_bars`: build the vendor's wide layout.

    The ticker list is fixed by the caller, so the column count is bounded.
    """
    fields = OHLC_FIELDS + ([VOLUME_FIELD] if include_volume else [])
    vals = [F.first(F.col(f.lower())).alias(f) for f in fields]
    wide = (ticker_filter(bars, tickers)
            .groupBy(F.col("bar_date").alias("Date")).pivot("ticker", as_list(tickers)).agg(*vals))
    # pivot names columns "<ticker>_<Field>"; rename to "<Field>|<ticker>"
    ren = []
    for c in wide.columns:
        if c == "Date":
            ren.append(F.col(c))
            continue
        t, f = c.rsplit("_", 1)
        ren.append(F.col(f"`{c}`").alias(f"{f}{sep}{t}"))
    return wide.select(*ren)
