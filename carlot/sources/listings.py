"""Reading and writing listing tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F, types as T

from carlot.schema import HIERARCHY_COLUMNS, LISTING_RAW, NA_TOKENS


#: Rows of one CSV file.  A file whose fields may hold line feeds is read by one task.
RECORDS_PER_FILE = 250_000
#: Text of a record that has not as many fields as its header.
_CORRUPT = "_corrupt_record"


def _csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    """One folder's records with the columns of ``schema`` by name, ``_CORRUPT`` and ``file``."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line)
    wanted = {f.name: f for f in schema}
    header = reader.csv(path).columns  # the first line of one file, and folder names
    require_columns(spark.createDataFrame([], ", ".join(f"`{c}` string" for c in header)), list(wanted))
    fields = [wanted.get(c, T.StructField(c, T.StringType())) for c in header]
    # a file whose header is not this one stops the job instead of being read by position
    found = reader.option("enforceSchema", False).option("columnNameOfCorruptRecord", _CORRUPT).schema(
        T.StructType([*fields, T.StructField(_CORRUPT, T.StringType())])
    ).csv(path)
    # the CSV source wants a column of the file to be read beside the record's text; always true
    read = F.coalesce(F.col(f"`{header[0]}`").cast("string"), F.lit("")) >= ""
    broken = F.when(read, F.col(_CORRUPT))
    return found.select(*wanted, broken.alias(_CORRUPT), F.col("_metadata.file_path").alias("file"))


def read_listings(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str = LISTING_RAW,
    multi_line: bool = True,
    rejects: bool = False,
) -> DataFrame:
    """Scan listing CSV files with a header; columns are found by name, in any order.

    A column of ``schema`` that the header lacks raises; others of the file are left out.
    Files below one path share one header, and a file with another stops the job;
    several paths may differ.  Quotes inside a field are doubled and titles may hold line
    feeds, so a file is read by one task; the writers here bound their files.  Uncompressed
    files known to hold one record per line can be read with ``multi_line=False``, which
    lets Spark split large files over tasks.

    Records with more or fewer fields than the header are no rows; with ``rejects`` they
    are returned instead, as ``file`` and ``record``.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    paths = [path] if isinstance(path, str) else path
    found = reduce(DataFrame.unionByName, [_csv(spark, p, schema, multi_line) for p in paths])
    if rejects:
        return found.where(F.col(_CORRUPT).isNotNull()).select("file", F.col(_CORRUPT).alias("record"))
    return found.where(F.col(_CORRUPT).isNull()).select(*schema.names)


def normalize_na(df: DataFrame) -> DataFrame:
    """Missing-value tokens become null in every string column."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(
        *[
            F.when(~F.col(c).isin(NA_TOKENS), F.col(c)).alias(c) if c in text else F.col(c)
            for c in df.columns
        ]
    )


def require_columns(df: DataFrame, columns: list[str] = HIERARCHY_COLUMNS) -> DataFrame:
    """Pass ``df`` on, or raise if a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}; needed: {', '.join(columns)}")
    return df


def csv_writer(df: DataFrame) -> DataFrameWriter:
    """Writer of CSV files that ``read_listings`` reads: gzip, of bounded length."""
    options = {"header": True, "quote": '"', "escape": '"', "compression": "gzip"}
    return df.write.options(**options).option("maxRecordsPerFile", RECORDS_PER_FILE)


def append_listings(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Add rows to the raw listing store, one folder per site; CSV files are gzipped."""
    writer = csv_writer(df) if file_format == "csv" else df.write
    writer.mode("append").partitionBy("site").format(file_format).save(path)


def write_processed(df: DataFrame, path: str) -> None:
    """Replace the processed listing table, gzipped CSV files."""
    csv_writer(df).mode("overwrite").csv(path)
