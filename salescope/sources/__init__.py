from salescope.sources.scratch import discard, file_bytes, materialise, path_exists, scratch_path
from salescope.sources.star import events_as_transactions, lineitems_as_transactions
from salescope.sources.transactions import (
    lookup_profiles,
    preview,
    read_by_month,
    read_parquet,
    read_transactions,
    rejected_rows,
    save_indexed_profiles,
    save_profiles,
    schema_of,
    top_saved_profiles,
    write_by_category,
    write_by_month,
    write_csv,
    write_parquet,
    write_ranked_csv,
)

__all__ = [
    "discard", "file_bytes", "materialise", "path_exists", "scratch_path", "events_as_transactions", "lineitems_as_transactions",
    "lookup_profiles", "preview", "read_by_month", "read_parquet", "read_transactions", "rejected_rows",
    "save_indexed_profiles", "save_profiles", "schema_of", "top_saved_profiles", "write_by_category", "write_by_month",
    "write_csv", "write_parquet", "write_ranked_csv",
]
