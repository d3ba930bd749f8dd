"""Typed CSV reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from featloom.sources.records import quoted_records

# The texts that stand for a missing field (an empty field is one more).
NULL_TOKENS = (
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def _typed(field: StructField, null_tokens: Sequence[str], required: bool) -> Column:
    text = F.when(~F.col(field.name).isin(*null_tokens), F.col(field.name))
    value = text
    if not isinstance(field.dataType, StringType):
        # The same in both ANSI modes: text that is not of the type is an error, never NULL.
        value = text.try_cast(field.dataType)
        message = F.concat(
            F.lit(f"column {field.name}: not {field.dataType.simpleString()}: "), text
        )
        value = F.coalesce(
            value, F.when(text.isNotNull(), F.raise_error(message).cast(field.dataType))
        )
    if required:
        message = F.lit(f"column {field.name}: value required")
        value = F.coalesce(value, F.raise_error(message).cast(field.dataType))
    return value.alias(field.name)


def read_csv_typed(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    null_tokens: Sequence[str] = NULL_TOKENS,
    required: Sequence[str] = (),
    multiline: bool = False,
) -> DataFrame:
    """CSV with a header row as the nullable columns of ``schema``.

    The file is read as text, the null tokens become NULL, and the rest is cast. The header must
    match the schema. A column in ``required`` fails on NULL. Quotes inside a quoted field are
    doubled. A record with too few or too many fields is an error. A record is one line, so that large
    files stay splittable. With ``multiline`` quoted fields may hold line breaks; files are split as well, but
    read twice, or three times if a record goes across splits. A field with
    a quote must then be quoted; line breaks in fields stay as they are.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    text_schema = StructType([StructField(f.name, StringType(), True) for f in schema])
    if multiline:
        raw = _parsed_records(quoted_records(spark, path), text_schema)
    else:
        # All fields are read, as otherwise nobody counts them.
        reader = spark.read.option("columnPruning", False).option("mode", "FAILFAST")
        raw = reader.csv(path, schema=text_schema, header=True, escape='"', enforceSchema=False)
    return raw.select([_typed(f, null_tokens, f.name in required) for f in schema])


def _parsed_records(records: DataFrame, schema: StructType) -> DataFrame:
    """The fields of each record but the headers, which must have the names of ``schema``."""
    options = {"mode": "FAILFAST", "escape": '"', "multiLine": "true", "columnPruning": "false"}
    columns = StructType([StructField(f"f{i}", StringType(), True) for i in range(len(schema))])
    parsed = F.from_csv("text", columns.simpleString()[len("struct<") : -1].replace(":", " "), options)
    # A generator's output is computed once, for the check of headers and for the fields.
    fields = records.select("first", F.explode(F.array(parsed)).alias("field"))
    names = F.array(*[F.lower(F.col(f"field.f{i}")) for i in range(len(schema))])
    wanted = F.array(*[F.lit(f.name.lower()) for f in schema])
    wrong = F.raise_error(F.lit("the header does not have the names of the schema")).cast("boolean")
    is_row = F.when(~F.col("first"), True).when(names.eqNullSafe(wanted), False).otherwise(wrong)
    kept = fields.filter(is_row)
    return kept.select(*[F.col(f"field.f{i}").alias(f.name) for i, f in enumerate(schema)])
