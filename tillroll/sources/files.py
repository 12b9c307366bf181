"""Transaction lines in files: CSV as shops export them, Parquet between jobs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillroll.schema import TRANSACTIONS, require_columns

# Layouts of a date, tried in this order: what it looks like, and how it is read. Slashes put the month first.
DATE_LAYOUTS = (
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,6})?$", "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]"),
    (r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$", "yyyy-MM-dd'T'HH:mm:ss"),
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$", "yyyy-MM-dd HH:mm"),
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$", "M/d/yyyy H:mm"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$", "M/d/yyyy H:mm:ss"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
)
_EMPTY = "\u0001empty\u0001"  # stands for a quoted empty text while a file is read; an unquoted one is NULL


def load_transactions(
    spark: SparkSession, path: str, format: str | None = None, encoding: str = "UTF-8", multi_line: bool = False
) -> DataFrame:
    """Read one CSV or Parquet file or folder. The customer id is always text.

    The format is taken from the path's suffix unless it is named. Columns are
    matched by the CSV header, in any order, and may be more than the eight
    needed. Quotes inside a quoted text are doubled. Dates may have any of
    ``DATE_LAYOUTS``, whole numbers a fraction of zero; anything else raises.
    Older shop exports are ``encoding="ISO-8859-1"``. Texts with line breaks
    need ``multi_line``, for which a file is read by one task. Workbooks must be
    exported to CSV first.
    """
    kind = format or path.rstrip("/").rsplit("/", 1)[-1].rpartition(".")[2].lower()
    if kind not in ("csv", "parquet"):
        raise ValueError(f"unsupported file format, name one of csv and parquet: {path}")
    try:
        if kind == "parquet":
            raw = spark.read.parquet(path)
        else:
            raw = spark.read.options(
                header=True, encoding=encoding, quote='"', escape='"', multiLine=multi_line, emptyValue=_EMPTY,
                ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
            ).csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from error
        raise
    raw = require_columns(raw, set(TRANSACTIONS.fieldNames()))
    return raw.select(*[_typed(raw, field).alias(field.name) for field in TRANSACTIONS])


def file_encodings(spark: SparkSession, path: str) -> dict[str, str]:
    """By file under ``path``: UTF-8 if all its lines are valid, else ISO-8859-1, which any bytes are valid in. One entry per file."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.is_valid_utf8("value").alias("fits"))
    return {r.file: "UTF-8" if r.fits else "ISO-8859-1" for r in lines.groupBy("file").agg(F.bool_and("fits").alias("fits")).collect()}


REASON = "reason"


def load_mixed(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(lines, bad rows) of a CSV file or folder whose files may have different encodings.

    Bad rows have the file, the ``reason`` and the row's text: another number of values than the header has, or a value that does
    not parse, of which the first column is named. The others are typed as ``load_transactions`` types them. All files
    have the columns of the transactions in one order. Files are read as they lie, so texts without line breaks only.
    """
    names = TRANSACTIONS.fieldNames()
    parts = []
    encodings = file_encodings(spark, path)
    for encoding in sorted(set(encodings.values())):
        files = sorted(f for f, e in encodings.items() if e == encoding)
        options = dict(
            header=True, encoding=encoding, quote='"', escape='"', emptyValue=_EMPTY, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
        header = require_columns(spark.read.options(**options).csv(files), set(names))
        original = spark.read.options(**options).csv(files).columns
        schema = T.StructType([*[T.StructField(c, T.StringType()) for c in original], T.StructField(_ROW, T.StringType())])
        raw = spark.read.schema(schema).options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=_ROW).csv(files)
        raw = raw.toDF(*header.columns, _ROW)
        parts.append(raw.select(*names, _ROW, F.col("_metadata.file_path").alias("file")))
    if not parts:
        raise FileNotFoundError(path)
    raw = union_periods(*parts)
    faults = [F.when(F.col(_ROW).isNotNull(), F.lit("number of values")), *[F.when(~_parses(raw, f), F.lit(f.name)) for f in TRANSACTIONS]]
    marked = raw.withColumn(REASON, F.coalesce(*faults))
    text = F.coalesce(_ROW, F.to_csv(F.struct(*[F.nullif(F.col(c), F.lit(_EMPTY)).alias(c) for c in names])))
    bad = marked.where(F.col(REASON).isNotNull()).select("file", REASON, text.alias("row"))
    return marked.where(F.col(REASON).isNull()).select(*[_typed(raw, f).alias(f.name) for f in TRANSACTIONS]), bad


_ROW = "_row"


def _parses(raw: DataFrame, field: T.StructField) -> Column:
    """Whether the text of a column can be read as its type; NULL and empty texts can."""
    value = F.trim(F.when(F.col(field.name) == _EMPTY, "").otherwise(F.col(field.name)))
    blank = F.coalesce(value, F.lit("")) == ""
    if isinstance(field.dataType, T.StringType):
        return F.lit(True)
    if isinstance(field.dataType, T.TimestampNTZType):
        known = F.lit(False)
        for shape, layout in reversed(DATE_LAYOUTS):
            known = F.when(value.rlike(shape), F.try_to_timestamp(value, F.lit(layout)).isNotNull()).otherwise(known)
        return blank | known
    if isinstance(field.dataType, T.IntegralType):
        value = F.regexp_replace(value, r"\.0*$", "")
    return blank | value.try_cast(field.dataType).isNotNull()


def parsed_date(text: Column) -> Column:
    """A timestamp from any of the known layouts; NULL from an empty text; other texts raise."""
    text = F.trim(text)
    out = F.when(text == "", F.lit(None))
    for shape, layout in DATE_LAYOUTS:
        out = out.when(text.rlike(shape), F.to_timestamp_ntz(text, F.lit(layout)))
    return out.otherwise(F.to_timestamp_ntz(text, F.lit(DATE_LAYOUTS[0][1])))


def _typed(raw: DataFrame, field: T.StructField) -> Column:
    value = F.col(field.name)
    if not isinstance(raw.schema[field.name].dataType, T.StringType):
        return value.cast(field.dataType)
    value = F.when(value == _EMPTY, "").otherwise(value)
    if isinstance(field.dataType, T.StringType):
        return value
    if isinstance(field.dataType, T.TimestampNTZType):
        return parsed_date(value)
    value = F.nullif(F.trim(value), F.lit(""))
    if isinstance(field.dataType, T.IntegralType):
        value = F.regexp_replace(value, r"\.0*$", "")
    return value.cast(field.dataType)


def union_periods(*periods: DataFrame) -> DataFrame:
    """All rows of several yearly tables, columns matched by name."""
    out = periods[0]
    for period in periods[1:]:
        out = out.unionByName(period)
    return out


def insert_rows(tx: DataFrame, rows: list[tuple]) -> DataFrame:
    """The table with some hand-written rows appended."""
    return tx.unionByName(tx.sparkSession.createDataFrame(rows, TRANSACTIONS))


def create_transactions(tx: DataFrame, name: str = "transactions") -> DataFrame:
    """Register the lines, cast to the declared types, as a view for SQL users."""
    typed = tx.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TRANSACTIONS])
    typed.createOrReplaceTempView(name)
    return typed


def save_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    """Write ``df`` so that ``load_transactions`` reads back the same texts: blanks kept, NULL apart from empty."""
    df.write.options(
        header=True, encoding=encoding, quote='"', escape='"', nullValue="", emptyValue='""',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, timestampNTZFormat="yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    ).csv(path)


def save_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
