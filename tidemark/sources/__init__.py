from tidemark.sources.dump import read_dump, write_dump
from tidemark.sources.files import read_by_name, write_delta
from tidemark.sources.relational import bounds_query, jdbc_options, projection
from tidemark.sources.tables import SourceSpec, clocks, open_table, opener
from tidemark.sources.window import incremental_window, window_bounds

__all__ = [
    "SourceSpec",
    "bounds_query",
    "clocks",
    "incremental_window",
    "jdbc_options",
    "open_table",
    "opener",
    "projection",
    "read_by_name",
    "read_dump",
    "window_bounds",
    "write_delta",
    "write_dump",
]
