from candela.sources.bars import build_bars  # noqa: F401
from candela.sources.tables import read_table, table_path  # noqa: F401
from candela.sources.ticks import (  # noqa: F401
    event_ticks, lineitem_ticks, load_event_ticks, load_lineitem_ticks, load_order_ticks,
    order_ticks,
)
