"""Tables by reference: parquet and other file formats, or JDBC."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from syncflow.sources import files


@dataclass(frozen=True)
class JdbcSplit:
    """How a JDBC read is cut into parallel range queries on a numeric or date column."""

    column: str
    lower: str
    upper: str
    partitions: int


@dataclass(frozen=True)
class TableRef:
    """Where a table lives. Connection settings come from the caller as options."""

    format: str = "parquet"
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict, repr=False)
    schema: T.StructType | None = None
    split: JdbcSplit | None = None

    def read_options(self) -> dict[str, str]:
        """Reader options, with the split spelled out for JDBC."""
        if self.split is None:
            return dict(self.options)
        if "query" in self.options:
            raise ValueError("a JDBC read can be split only with 'dbtable', not with 'query'")
        return {
            **self.options,
            "partitionColumn": self.split.column,
            "lowerBound": self.split.lower,
            "upperBound": self.split.upper,
            "numPartitions": str(self.split.partitions),
        }


def newest_value(
    ref: TableRef, column: str, conditions: Sequence[tuple[str, str, str | int]] = ()
) -> TableRef:
    """A JDBC table reduced by the database to the greatest value of ``column``.

    The reader pushes filters and columns into JDBC, but no aggregates: without
    this every row of a log would be fetched to find its maximum. A condition is
    (column, ``=`` or ``<>``, value). Names are taken as they are written in the
    settings; text values are quoted. Other tables are given back as they are.
    """
    table = ref.options.get("dbtable")
    if ref.format != "jdbc" or table is None:
        return ref

    def literal(value: str | int) -> str:
        return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(int(value))

    parts = []
    for name, operator, value in conditions:
        if operator not in ("=", "<>"):
            raise ValueError(f"the operator must be '=' or '<>', not {operator!r}")
        parts.append(f"{name} {operator} {literal(value)}")
    within = f" WHERE {' AND '.join(parts)}" if parts else ""
    others = {k: v for k, v in ref.options.items() if k != "dbtable"}
    query = f"SELECT MAX({column}) AS {column} FROM {table}{within}"
    return TableRef(ref.format, None, {**others, "query": query}, ref.schema)


def read_table(spark: SparkSession, ref: TableRef) -> DataFrame:
    """Read a table. Filters and projections put on the result reach the source.

    A file table with a schema may not exist yet: it reads as empty.
    """
    if ref.path is not None and ref.schema is not None and not files.exists(spark, ref.path):
        return spark.createDataFrame([], ref.schema)
    reader = spark.read.format(ref.format).options(**ref.read_options())
    if ref.schema is not None and ref.format != "jdbc":
        reader = reader.schema(ref.schema)
    return reader.load(ref.path) if ref.path else reader.load()


def append_table(df: DataFrame, ref: TableRef) -> None:
    """Append rows from the executors; earlier rows stay."""
    writer = df.write.format(ref.format).options(**ref.options).mode("append")
    if ref.path:
        writer.save(ref.path)
    else:
        writer.save()
