"""Sources and sinks."""

from cartwheel.sources.retail import (  # noqa: F401
    conform_raw, read_raw_transactions, read_table, register_view, to_canonical_names,
    use_database, write_table,
)
