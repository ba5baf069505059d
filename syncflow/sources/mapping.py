"""Column mapping files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from syncflow.operators.reshape import ColumnMap

NO_TYPE = "NA"


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """The file as written: header line, quoted fields, every column text."""
    return spark.read.option("header", True).csv(path)


def load_mapping(
    spark: SparkSession,
    path: str,
    source_col: str = "source",
    target_col: str = "target",
    type_col: str | None = "dtype",
) -> list[ColumnMap]:
    """The lines of a mapping file in file order (one line per column, so small).

    ``NA`` or an empty type means that the column is not cast.
    """
    columns = [source_col, target_col] + ([type_col] if type_col else [])
    maps = []
    for row in read_mapping(spark, path).select(*columns).collect():
        dtype = row[2] if type_col else None
        maps.append(ColumnMap(row[0], row[1], None if dtype in (None, "", NO_TYPE) else dtype))
    return maps
