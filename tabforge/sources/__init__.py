from tabforge.sources.tables import (  # noqa: F401
    TABLES, read_table, read_csv, write_csv, write_predictions,
)
