from candela.sinks.writers import (  # noqa: F401
    append_quote_log, read_snapshot, write_feed, write_snapshot,
)
