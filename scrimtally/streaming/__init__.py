from .ingest import incremental_ingest, ingested_log, ingested_matches  # noqa: F401
