from creditlens.sources.tables import (  # noqa: F401
    DRIVER_TABLES, Tables, nan_to_null, read_csv_na, read_table, write_csv_na,
)
