"""Where raw rows come from: delimited files, parquet files, star-schema tables, JDBC."""

from ordermill.sources.files import SOURCE_ORDER, infer_layouts, read_raw

__all__ = ["SOURCE_ORDER", "infer_layouts", "read_raw"]
