"""Records that the remote side hands over as files: object pulls and delivery results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncflow.functions.columns import quoted
from syncflow.operators.reshape import ColumnMap

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("success", T.StringType()),
        T.StructField("created", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)


def object_schema(
    maps: Sequence[ColumnMap], types: dict[str, str] | None = None
) -> T.StructType:
    """Read schema of a pulled object: the mapped columns and no others.

    ``types`` overrides the type of single columns, for instance ``boolean``
    for a flag whose mapping calls it text.
    """
    types = types or {}
    parts = [f"`{m.source}` {types.get(m.source, m.spark_type or 'string')}" for m in maps]
    return T.StructType.fromDDL(", ".join(parts))


def read_json_object(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    multi_line: bool = False,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Read landed JSON pages with a fixed schema.

    A line may hold one record or an array of records. ``multi_line`` is for
    pages that span lines; such a page is read by one task. Columns outside the
    schema are not parsed; an absent attribute is null; no files give no rows.
    """
    reader = spark.read.schema(schema).option("multiLine", multi_line).options(**(options or {}))
    return reader.json(path)


def read_json_variant(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    multi_line: bool = False,
    rest: str = "unmapped",
    corrupt: str = "_corrupt_record",
) -> DataFrame:
    """Read landed JSON pages whole: typed columns, and all other attributes as a VARIANT.

    The columns of ``schema`` are taken out of the parsed record. What the schema does not
    name is kept in ``rest`` with its types (null if there is nothing), so an attribute that
    the remote side adds later is not lost. Lines and arrays as for ``read_json_object``. A line that
    is no JSON, and a record whose attribute does not fit its type, have their text in ``corrupt``
    and nulls elsewhere.
    """
    named = [f for f in schema.fields if f.name not in (rest, corrupt)]
    lines = spark.read.text(path, wholetext=multi_line)
    page = F.try_parse_json("value")
    records = F.coalesce(
        F.try_variant_get(page, "$", "array<variant>"), F.array(page)
    )
    rows = lines.where(F.trim("value") != "").select(
        "value", F.explode(records).alias("record")
    )
    attributes = F.col("record").try_cast("map<string,variant>")
    broken = attributes.isNull()
    columns = []
    for f in named:
        held = F.element_at(attributes, f.name)
        value = F.try_variant_get(held, "$", f.dataType.simpleString())
        broken = broken | (held.isNotNull() & ~F.is_variant_null(held) & value.isNull())
        columns.append(value.alias(f.name))
    names = [f.name for f in named]
    others = F.map_filter(attributes, lambda k, _: ~k.isin(*names))
    whole = rows.select(
        *columns,
        F.when(F.size(others) > 0, F.parse_json(F.to_json(others))).alias(rest),
        F.when(broken, F.coalesce(F.to_json("record"), F.col("value"))).alias(corrupt),
    )
    fine = quoted(corrupt).isNull()
    return whole.select(
        *[F.when(fine, quoted(c)).alias(c) for c in [*names, rest]], quoted(corrupt)
    )


def read_results(
    spark: SparkSession,
    path: str,
    file_format: str = "csv",
    extra: Sequence[str] = (),
) -> DataFrame:
    """Per-record delivery results: ``id, success, created, error`` plus ``extra``.

    The schema is fixed, so an empty result set is a table without rows. CSV
    headers are checked against it instead of being trusted by position.
    """
    schema = T.StructType([*RESULT_SCHEMA.fields, *[T.StructField(c, T.StringType()) for c in extra]])
    reader = spark.read.schema(schema)
    if file_format == "csv":
        reader = reader.options(header=True, enforceSchema=False, escape='"', multiLine=True)
    return reader.format(file_format).load(path)


def results_frame(df: DataFrame, ident: str, success, error, **extra) -> DataFrame:
    """Shape delivery results out of columns at hand (no remote side involved)."""
    return df.select(
        F.col(ident).cast("string").alias("id"),
        success.cast("string").alias("success"),
        F.lit(None).cast("string").alias("created"),
        error.cast("string").alias("error"),
        *[column.alias(name) for name, column in extra.items()],
    )
