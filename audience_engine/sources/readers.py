"""Reading comment snapshots, tables and logs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from audience_engine.functions.clock import event_time
from audience_engine.operators.conform import conform_comments
from audience_engine.schemas import RAW_SCHEMAS
from audience_engine.sources.split_csv import read_split_csv

BAD_RECORD = "_corrupt_record"


def _with_bad_records(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType())])


def read_texts_csv(spark: SparkSession, path: str, keep_bad: bool = False, multi_line: bool = True) -> DataFrame:
    """A CSV with a header, every column as text under its header's name.

    ``multi_line`` lets texts in quotes span lines; a file is cut at its records and read by many tasks either way (``split_csv``).
    """

    def reader(schema: T.StructType | None):
        own = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
        return own if schema is None else own.schema(schema).option("columnNameOfCorruptRecord", BAD_RECORD)

    header = reader(None).csv(path).schema
    schema = _with_bad_records(header) if keep_bad else header
    if multi_line and header.fields:
        return read_split_csv(spark, path, schema, columnNameOfCorruptRecord=BAD_RECORD)
    return reader(schema).csv(path)


def typed_as(df: DataFrame, schema: T.StructType, mark_bad: bool = False) -> DataFrame:
    """Exactly the columns of ``schema`` by name, bad values as null, absent columns null.

    ``mark_bad`` adds the whole row as text where a value is bad or the reader found the record malformed.
    """
    known = {c.strip().lower(): c for c in df.columns}
    if not any(f.name.lower() in known for f in schema):
        raise ValueError(f"none of {schema.names} is among the columns {df.columns}")

    def column(field: T.StructField) -> Column:
        name = known.get(field.name.lower())
        value = F.lit(None) if name is None else F.col(f"`{name}`")
        return (value.cast(field.dataType) if name is None else value.try_cast(field.dataType)).alias(field.name)

    if not mark_bad:
        return df.select(*[column(f) for f in schema])
    cells = [F.col(f"`{known[f.name.lower()]}`") for f in schema if f.name.lower() in known]
    typed = [f for f in schema if f.name.lower() in known]
    spoilt = [(c != "") & F.isnull(c.try_cast(f.dataType)) for c, f in zip(cells, typed, strict=True)]
    row = F.concat_ws(",", *cells)
    bad = F.when(reduce(or_, [F.coalesce(s, F.lit(False)) for s in spoilt]), row)
    malformed = [F.col(BAD_RECORD)] if BAD_RECORD in df.columns else []
    return df.select(*[column(f) for f in schema], F.coalesce(*malformed, bad).alias(BAD_RECORD))


def read_comments_csv(
    spark: SparkSession, path: str, platform: str, keep_bad: bool = False, schema: T.StructType | None = None, multi_line: bool = True
) -> DataFrame:
    """A platform's CSV snapshot, columns taken by their header's names. Bad records are marked only on request."""
    texts = read_texts_csv(spark, path, keep_bad, multi_line)
    return typed_as(texts, schema or RAW_SCHEMAS[platform], mark_bad=keep_bad)


def read_comments_jsonl(spark: SparkSession, path: str, platform: str, keep_bad: bool = False) -> DataFrame:
    """A platform's JSON-lines snapshots; a ``dt`` folder level becomes a column."""
    schema = RAW_SCHEMAS[platform]
    if not keep_bad:
        return spark.read.schema(schema).json(path)
    return spark.read.schema(_with_bad_records(schema)).option("columnNameOfCorruptRecord", BAD_RECORD).json(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A named table; a missing name is an error."""
    return spark.table(name)


def first_nonempty(dfs: Sequence[DataFrame]) -> DataFrame:
    """The first table with a row; the last one when all are empty."""
    for df in dfs[:-1]:
        if not df.isEmpty():
            return df
    return dfs[-1]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system that Spark reads has files; an empty path has none."""
    if not path.strip():
        return False
    try:
        return len(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").take(1)) > 0
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise


def resolve_source(spark: SparkSession, path: str, table: str, platform: str, schema: T.StructType | None = None) -> DataFrame:
    """The local CSV snapshot when there is one, else the stored table; conformed either way."""
    raw = read_comments_csv(spark, path, platform, schema=schema) if path_exists(spark, path) else read_table(spark, table)
    return conform_comments(raw, platform)


def read_training(spark: SparkSession, path: str, label: str = "target", schema: T.StructType | str | None = None) -> DataFrame:
    """Training rows from CSV; the label column must be there. With a ``schema`` the file is read once, without it twice."""
    reader = spark.read.option("header", True)
    df = reader.schema(schema).option("enforceSchema", False).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    if label not in df.columns:
        raise ValueError(f"training data needs a '{label}' column")
    return df


AB_LOG_TEXTS = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("post_id", "topic", "variant_id", "variant_text", "ts", "replies", "likes", "ctr")]
)


def read_ab_log(spark: SparkSession, path: str) -> DataFrame:
    """The A/B log, columns by name; blank or bad metrics and times are null."""
    return type_ab_log(typed_as(read_texts_csv(spark, path), AB_LOG_TEXTS))


def type_ab_log(raw: DataFrame) -> DataFrame:
    """Typed metrics of a log whose cells are text."""
    ctr = F.col("ctr").try_cast("double")
    return raw.withColumns(
        {
            "ts": event_time("ts"),
            "replies": F.col("replies").try_cast("long"),
            "likes": F.col("likes").try_cast("long"),
            "ctr": F.when(~F.isnan(ctr), ctr),
        }
    )
