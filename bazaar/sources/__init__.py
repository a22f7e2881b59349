from bazaar.sources.tables import (  # noqa: F401
    TABLES, table, read_table, read_arms, read_jdbc, register, publish_view,
    export_parquet, file_inventory,
)
