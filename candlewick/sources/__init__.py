from candlewick.sources.landing import envelope_lines, land, read_landing, read_landing_stream
from candlewick.sources.promotion import promote, promoted_lines
from candlewick.sources.registry import SOURCES, TABLES, BronzeTable, Source
from candlewick.sources.tables import append_table, recover_table, replace_table, table_or_none

__all__ = [
    "SOURCES",
    "TABLES",
    "BronzeTable",
    "Source",
    "append_table",
    "envelope_lines",
    "land",
    "promote",
    "promoted_lines",
    "read_landing",
    "read_landing_stream",
    "recover_table",
    "replace_table",
    "table_or_none",
]
