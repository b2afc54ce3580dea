"""Session settings and reliable lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "audience_engine", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and a UTC clock; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session (tests) may fall back to a folder of its own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="audience-engine-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for one staged table under the shared root."""
    path = f"{scratch_root(spark).rstrip('/')}/staged-{name}-{uuid.uuid4().hex}"
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


#: Spark's switch (4.1) to remove the shuffle files of a query when it ends, not when the driver happens to collect its garbage.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Each query that runs inside leaves no shuffle files: for work in many steps, which else all lie on disk at once."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def drop_staged(*tables: DataFrame) -> None:
    """Remove tables of ``cut_lineage`` that nothing will read any more, ahead of the run's end."""
    for table in tables:
        spark = table.sparkSession
        staged = _STAGED.get(spark.sparkContext.applicationId, [])
        for name in {file.rsplit("/", 2)[-2] for file in table.inputFiles()}:
            for path in [p for p in staged if p.endswith(f"/{name}")]:
                staged.remove(path)
                _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from there.

    Iterative readers then survive a lost executor without recomputing what came before, and, the table being
    columnar and compressed, each of them reads only its own columns.
    """
    spark = df.sparkSession
    path = staging_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_by(df: DataFrame, column: str) -> DataFrame:
    """As ``cut_lineage``, for a large table that is read by the values of its last column; packed more tightly."""
    path = staging_path(df.sparkSession, "table")
    df.write.option("compression", "zstd").partitionBy(column).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_alone(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """``cut_lineage`` of what ``build`` returns, without the tables that it staged on the way."""
    paths = _STAGED.setdefault(spark.sparkContext.applicationId, [])
    before = set(paths)
    built = build()
    inner = [p for p in paths if p not in before]
    out = cut_lineage(built)
    for path in inner:
        if path in paths:
            paths.remove(path)
            _delete(spark, path)
    return out


ROWS_PER_PART = 50_000


def laid_out(df: DataFrame, *keys: str, rows: int | None = None, per_part: int = ROWS_PER_PART) -> DataFrame:
    """The same rows in partitions and order that follow from the data alone, for work that draws by partition.

    The number of partitions comes from the number of rows, not from the cluster.
    """
    count = df.count() if rows is None else rows
    parts = max(8, -(-count // per_part))
    return df.repartition(parts, *keys).sortWithinPartitions(*keys)


_STAGED: dict[str, list[str]] = {}


@contextmanager
def staged_for_now(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, the tables that were staged inside: for work whose results are collected or written by then."""
    paths = _STAGED.setdefault(spark.sparkContext.applicationId, [])
    before = len(paths)
    try:
        yield
    finally:
        while len(paths) > before:
            _delete(spark, paths.pop())


def use_all_cores(df: DataFrame) -> DataFrame:
    """Spread a stored table that has fewer splits than there are cores, ahead of heavy or iterative work.

    Call it right after a read or ``cut_lineage``: there, counting the splits costs no job. A large table has far
    more splits than cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
