from tidemark.sources.buckets import clean_in_buckets, write_bucketed
from tidemark.sources.publish import current_version, publish, publish_report
from tidemark.sources.readers import as_views, jdbc_options, read_jdbc, read_jdbc_tables, read_tables
from tidemark.sources.writers import write_csv, write_parquet, write_report, write_tables

__all__ = [
    "as_views",
    "clean_in_buckets",
    "current_version",
    "jdbc_options",
    "publish",
    "publish_report",
    "read_jdbc",
    "read_jdbc_tables",
    "read_tables",
    "write_bucketed",
    "write_csv",
    "write_parquet",
    "write_report",
    "write_tables",
]
