from candela.functions.expr import (  # noqa: F401
    iso_utc, nan_to_null, py_isoformat, as_list, split_tickers, valid_price,
)
