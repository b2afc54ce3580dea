"""Writing snapshots, tables, logs and manifests."""

from __future__ import annotations

import json
import logging

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from audience_engine.settings import Settings
from audience_engine.sources.readers import path_exists, read_texts_csv

log = logging.getLogger(__name__)


def cell_safe(df: DataFrame) -> DataFrame:
    """Every cell as text: null and NaN empty, arrays, maps and structs as JSON."""

    def cell(field: T.StructField):
        col = F.col(field.name)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            col = F.to_json(col)
        elif isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            col = F.when(~F.isnan(col), col)
        return F.coalesce(col.cast("string"), F.lit("")).alias(field.name)

    return df.select(*[cell(field) for field in df.schema])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV parts with a header, also for an empty table."""
    cell_safe(df).write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_jsonl(df: DataFrame, path: str, date: str | None = None, mode: str = "append") -> None:
    """A daily JSON-lines snapshot under ``dt=...``, by ``date`` or the table's own ``dt`` column."""
    dated = df if date is None else df.withColumn("dt", F.lit(date))
    dated.write.mode(mode).partitionBy("dt").json(path)


def replace_table(df: DataFrame, name: str) -> None:
    """The table becomes exactly these rows."""
    df.write.mode("overwrite").saveAsTable(name)


def append_table(df: DataFrame, name: str, schema: T.StructType | None = None) -> None:
    """Append rows to a table that is made on first use; names and types must agree."""
    spark = df.sparkSession
    known = spark.catalog.tableExists(name)
    wanted = spark.table(name).schema if known else schema
    if wanted is not None:
        have = [(f.name, f.dataType) for f in df.schema]
        want = [(f.name, f.dataType) for f in wanted]
        if have != want:
            raise ValueError(f"columns do not fit {name}: have {have}, want {want}")
    df.write.mode("append").saveAsTable(name)


def bulk_load(spark: SparkSession, tables: dict[str, str], skip_missing: bool = False, multi_line: bool = True) -> dict[str, bool]:
    """Replace several tables by CSV files; says which were loaded. A missing or empty file is skipped or an error."""
    loaded = {}
    for name, path in tables.items():
        found = path_exists(spark, path)
        if not found and not skip_missing:
            raise FileNotFoundError(path)
        if found:
            df = read_texts_csv(spark, path, multi_line=multi_line)
            found = len(df.columns) > 0
            if found:
                replace_table(df, name)
        loaded[name] = found
    return loaded


def write_manifest(spark: SparkSession, settings: Settings, path: str, **extra: str) -> None:
    """Append the run's real settings as one JSON row."""
    row = json.dumps({**settings.manifest(), **extra}, ensure_ascii=False)
    spark.range(1).select(F.lit(row).alias("value")).write.mode("append").text(path)


def write_with_fallback(df: DataFrame, name: str, path: str) -> str:
    """Replace a table; if that fails, write CSV for inspection. Says which was written."""
    try:
        replace_table(df, name)
        return name
    except (AnalysisException, PySparkException, Py4JJavaError) as error:
        log.warning("table %s was not written (%s); rows go to %s", name, error, path)
        write_csv(df, path)
        return path
