from .readers import (  # noqa: F401
    LAYOUT,
    SourceMissing,
    delete_path,
    missing_tables,
    path_exists,
    present,
    read_bucketed,
    read_columns,
    read_csv,
    read_csv_or_empty,
    read_optional,
    read_parquet,
    read_star,
    register_views,
    resolve_source,
)
from .writers import (  # noqa: F401
    CODEC,
    append_log,
    export_tables,
    load_jdbc,
    schema_columns,
    write_bucketed,
    write_csv,
    write_parquet,
    write_table,
)
