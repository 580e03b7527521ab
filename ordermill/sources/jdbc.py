"""Clean rows to and from a relational database, for sites that keep the mart in one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

IF_EXISTS_MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    if_exists: str = "append",
    chunk_size: int = 5000,
    connections: int = 8,
    properties: dict[str, str] | None = None,
) -> None:
    """Insert rows in batches of ``chunk_size`` over at most ``connections`` parallel connections.

    Each partition is one transaction; a repeated task can insert again unless the table has a
    unique key, so give the target one.
    """
    writer = df.write.mode(IF_EXISTS_MODES[if_exists])
    options = {"batchsize": str(chunk_size), "numPartitions": str(connections), **(properties or {})}
    writer.options(**options).format("jdbc").option("url", url).option("dbtable", table).save()


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    connections: int = 8,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A table, split over ``connections`` readers by ranges of ``partition_column`` when one is named."""
    reader = spark.read.format("jdbc").options(**(properties or {})).option("url", url).option("dbtable", table)
    if partition_column is not None:
        if bounds is None:
            raise ValueError("bounds are needed to split the read")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", str(connections))
        )
    return reader.load()
