"""Where a row stood in its source."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def place_columns() -> list[Column]:
    """File of a row and the offset of the part of the file it was read with."""
    return [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
