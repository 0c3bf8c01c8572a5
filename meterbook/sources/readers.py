"""Scans of the three file formats into text columns.

Each scan adds ``_source_file``, the row's place (``PLACE``: file, block and running number give the order
of rows in the source, and with the scan they are unique) and ``_parse_error`` / ``_raw_line`` for lines that are no record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterbook.sources.registry import SourceSpec

MALFORMED = "malformed JSON"
NOT_AN_OBJECT = "line is not a JSON object"

JSON_OPTIONS = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}


PLACE = ("_file", "_block", "_number", "_scan")


def _scan_columns(scan: int = 0) -> list[Column]:
    return [
        F.col("_metadata.file_name").alias("_source_file"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_number"),
        F.lit(scan).alias("_scan"),
    ]


_PLACE = ("_source_file", *PLACE)


def _no_errors(df: DataFrame) -> DataFrame:
    return df.withColumns({"_parse_error": F.lit(None).cast("string"), "_raw_line": F.lit(None).cast("string")})


def read_csv(spark: SparkSession, spec: SourceSpec, path: str) -> DataFrame:
    """SRC-01: every cell is text, only the empty cell is NULL, nothing is trimmed.

    A file with line breaks inside quotes must be parsed as a whole; any other file can be split
    into blocks. A line with an odd number of quotes tells them apart, so only files that need it
    lose the split.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    broken = [r["file"] for r in lines.filter(quotes % 2 == 1).select("file").distinct().collect()]

    names = _csv_reader(spark).csv(path).columns or list(spec.columns)
    parsed = _csv(spark, spec, names, path, multi_line=False)
    if broken:
        split = parsed.filter(~F.col("_file").isin(broken))
        return split.unionByName(_csv(spark, spec, names, broken, multi_line=True))
    return parsed


def _csv_reader(spark: SparkSession) -> DataFrameReader:
    return (
        spark.read.option("header", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("quote", '"')
        .option("escape", '"')
    )


def _csv(
    spark: SparkSession, spec: SourceSpec, names: list[str], path: str | list[str], multi_line: bool
) -> DataFrame:
    """Columns go by the names in the header, in whatever order; one that is missing is NULL."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    reader = _csv_reader(spark).schema(schema).option("enforceSchema", False).option("multiLine", multi_line)
    columns = [F.col(c) if c in names else F.lit(None).cast("string").alias(c) for c in spec.columns]
    return _no_errors(reader.csv(path).select(*columns, *_scan_columns(int(multi_line))))


def read_jsonl(spark: SparkSession, spec: SourceSpec, path: str) -> DataFrame:
    """SRC-02: blank lines are skipped; a line that is no JSON object becomes a reject."""
    lines = (
        spark.read.text(path)
        .select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("line"), *_scan_columns())
        .filter(F.col("line") != "")
    )
    # The line is parsed as the only member of an object, since a parser stops at the end of the
    # first value and would not see what follows it on the line.
    wrapped = F.concat(F.lit('{"doc":'), F.col("line"), F.lit("}"))
    typed = {spec.key, spec.checked_time}
    fields = T.StructType(
        [T.StructField(c, T.VariantType() if c in typed else T.StringType()) for c in spec.columns]
    )
    schema = T.StructType([T.StructField("doc", fields), T.StructField("_corrupt_record", T.StringType())])
    parsed = lines.select(
        "line",
        *_PLACE,
        F.from_json(wrapped, schema, JSON_OPTIONS).alias("j"),
        F.json_object_keys(wrapped).alias("members"),
    )
    # A document that holds NaN has no member list; the parser above has still read it strictly.
    is_record = F.col("j.doc").isNotNull() & (F.coalesce(F.size("members"), F.lit(1)) == 1)
    is_value = ~F.col("line").startswith("{") & F.try_parse_json("line").isNotNull()
    error = F.when(~is_record, F.when(is_value, NOT_AN_OBJECT).otherwise(MALFORMED))

    def value(column: str) -> Column:
        field = F.col(f"j.doc.{column}")
        return F.try_variant_get(field, "$", "string") if column in typed else field

    return parsed.select(
        *[F.when(is_record, value(c)).alias(c) for c in spec.columns],
        *_PLACE,
        error.alias("_parse_error"),
        F.when(~is_record, F.col("line")).alias("_raw_line"),
        *[
            (is_record & ~F.schema_of_variant(F.col(f"j.doc.{c}")).isin("STRING", "VOID")).alias(f"_not_text_{c}")
            for c in sorted(typed)
        ],
    )


def read_parquet(spark: SparkSession, spec: SourceSpec, path: str) -> DataFrame:
    """SRC-03: values become text, NaN becomes NULL."""
    stored = spark.read.parquet(path)
    types = dict(stored.dtypes)

    def text(column: str) -> Column:
        if column not in types:
            return F.lit(None).cast("string").alias(column)
        c = F.col(column)
        if types[column] in ("float", "double"):
            c = F.when(~F.isnan(c), c)
        return c.cast("string").alias(column)

    return _no_errors(stored.select(*[text(c) for c in spec.columns], *_scan_columns()))


READERS = {"csv": read_csv, "jsonl": read_jsonl, "parquet": read_parquet}


def read_source(spark: SparkSession, spec: SourceSpec, path: str) -> DataFrame:
    return READERS[spec.format](spark, spec, path)
