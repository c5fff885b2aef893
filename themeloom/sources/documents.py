"""Document tables in, result tables out."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from themeloom.session import materialize

# Column names a document table is recognised by.
REQUIRED_COLUMNS = ("Title", "Abstract")
TEXT_COLUMN_NAMES = ("abstract", "text", "content", "body", "title")

DOCUMENT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in REQUIRED_COLUMNS])


def read_documents(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType | str | None = DOCUMENT_SCHEMA,
    required: tuple[str, ...] = REQUIRED_COLUMNS,
    multi_line: bool = True,
) -> DataFrame:
    """Scan a document table; CSV with a header and quoted fields that may hold line breaks.

    With ``multi_line`` a CSV file is one task, since a quoted line break can stand anywhere; without it
    files are split. A large corpus belongs in Parquet. A missing path is a ``ValueError``; a missing required column is a ``KeyError``. For CSV the
    header is read first, so columns may stand in any order and extra ones stay as strings; those that
    ``schema`` names get its types.
    """
    reader = spark.read
    if fmt == "csv":
        reader = (
            reader.option("header", True).option("multiLine", multi_line)
            .option("quote", '"').option("escape", '"').option("inferSchema", False)
        )
    elif schema is not None and fmt == "json":
        reader = reader.schema(schema)
    try:
        df = reader.format(fmt).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise ValueError(f"File not found: {path}") from error
        raise
    require_columns(df, required)
    if schema is not None and fmt == "csv":
        wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        kinds = {f.name: f.dataType for f in wanted if f.name in df.columns}
        df = df.select(*(F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in df.columns))
    return df


def require_columns(df: DataFrame, required: tuple[str, ...] = REQUIRED_COLUMNS) -> None:
    for name in required:
        if name not in df.columns:
            raise KeyError(name)


def text_columns(df: DataFrame) -> list[str]:
    """Columns that look like text, in table order."""
    return [c for c in df.columns if c.lower() in TEXT_COLUMN_NAMES]


def default_text_column(df: DataFrame) -> str | None:
    """``Abstract`` (then ``abstract``) if there is one, else the first text column."""
    found = text_columns(df)
    for preferred in ("Abstract", "abstract"):
        if preferred in found:
            return preferred
    return found[0] if found else None


def with_doc_id(df: DataFrame) -> DataFrame:
    """Give rows an id if they have none.

    The ids are generated, so the table is written once and read back: a recomputed stage can
    never see other ids than its siblings.
    """
    if "doc_id" in df.columns:
        return df
    return materialize(df.withColumn("doc_id", F.monotonically_increasing_id()), "documents")


def flatten_for_csv(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, since CSV has no nested types."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a result table as parquet, JSON or CSV with a header."""
    out = flatten_for_csv(df) if fmt == "csv" else df
    writer = out.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
    writer.format(fmt).save(path)


def write_predictions(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Predictions sink with the columns ``Document`` and ``Topic``."""
    write_table(df.select(F.col("doc").alias("Document"), F.col("topic").alias("Topic")), path, fmt)
