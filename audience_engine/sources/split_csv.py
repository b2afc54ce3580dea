"""CSV whose quoted texts may span lines, read by many tasks per file.

Spark's line reader splits a file by bytes, but whether a line end lies inside quotes depends on everything before it. A first
pass counts, for every split, its quote marks and the lines that would end a record if the split began outside quotes; the
others would if it began inside. One small row per split (of 128 MB by default) goes to the driver, which runs through the splits of each file
in order: the parity of the quote marks before a split says how it begins, and the record ends before it give the number of
its first record. A second pass cuts each split into records; a record that crosses into other splits leaves a fragment in
each of them, and the fragments, a few per split, are put together by the number of their record.

Records are parsed by Spark's own CSV parser. Quote marks must only stand around fields and, doubled, inside them, as
CSV writers have it; a lone mark inside a bare field would turn the parity. Lines end with a line feed, with or
without a carriage return before it; texts in quotes stay as they are written. Each file has a header, which is its first record; blank lines are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPLIT = ["file", "start"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``value``, and the file (hashed) and first byte of the split that each line is read in, in order."""
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select("value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _by_split(batches) -> Iterator[tuple[tuple[int, int], pa.Array, np.ndarray]]:
    """(split, its lines, quote marks of each) in order, a split in one part per batch."""
    for batch in batches:
        file, start = (np.asarray(batch.column(c)) for c in _SPLIT)
        lines = batch.column("value")
        marks = np.asarray(pc.count_substring(lines, '"')).astype(np.int64)
        edges = [0, *(np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1).tolist(), len(file)]
        for low, high in zip(edges, edges[1:], strict=False):
            if high > low:
                yield (int(file[low]), int(start[low])), lines.slice(low, high - low), marks[low:high]


def _measured(lines: DataFrame) -> list:
    """Per split: lines, whether its quote marks are odd, and the lines that end a record if it begins outside quotes."""

    def run(batches):
        found: dict[tuple[int, int], list[int]] = {}
        for split, own, marks in _by_split(batches):
            state = found.setdefault(split, [0, 0, 0])
            inside = (state[1] + np.cumsum(marks)) % 2
            state[0] += len(own)
            state[1] = int(inside[-1])
            state[2] += int((inside == 0).sum())
        columns = [[k[0] for k in found], [k[1] for k in found], *([v[i] for v in found.values()] for i in range(3))]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[*_SPLIT, "lines", "odd", "ends"])

    return lines.mapInArrow(run, "file long, start long, lines long, odd long, ends long").collect()  # one row per split


def beginnings(splits: list) -> dict[tuple[int, int], tuple[int, int]]:
    """How each split begins: (1 inside quotes, else 0; the number of its first record in the file)."""
    out: dict[tuple[int, int], tuple[int, int]] = {}
    file, inside, number = None, 0, 0
    for row in sorted(splits):
        if row[0] != file:
            file, inside, number = row[0], 0, 0
        out[row[0], row[1]] = (inside, number)
        number += row[2] - row[4] if inside else row[4]
        inside ^= row[3]
    return out


def _records(lines: DataFrame, known, fragments: bool) -> DataFrame:
    """The ``record`` texts that lie in one split, or the ``fragments`` (``file``, ``number``, ``start``, ``record``) of the others."""
    schema = "file long, number long, start long, record string" if fragments else "record string"

    def run(batches):
        begins = known.value
        split, inside, number, open_lines, whole = None, 0, 0, [], True
        out: list[tuple[int, int, int, str]] = []

        def fragment(text: list[str]) -> None:
            if fragments and text:
                out.append((split[0], number, split[1], "\n".join(text)))

        for key, own, marks in _by_split(batches):
            if key != split:
                fragment(open_lines)
                if key not in begins:
                    raise RuntimeError("the file was split in another way than before: keep the session's split settings while it is read")
                split, (inside, number), open_lines = key, begins[key], []
                whole = not inside  # of the first record
            state = (inside + np.cumsum(marks)) % 2
            inside = int(state[-1])
            if not open_lines and whole and number and not state.any():  # every line is a record
                number += len(own)
                if not fragments:
                    yield pa.RecordBatch.from_arrays([own.cast(pa.string())], names=["record"])
                continue
            records, at, texts = [], 0, own.to_pylist()
            for end in np.flatnonzero(state == 0).tolist():
                text = open_lines + texts[at : end + 1]
                if not whole:
                    fragment(text)
                elif number:  # the first record of a file is its header
                    records.append("\n".join(text))
                open_lines, at, whole = [], end + 1, True
                number += 1
            open_lines += texts[at:]
            if records and not fragments:
                yield pa.RecordBatch.from_arrays([pa.array(records, pa.string())], names=["record"])
        fragment(open_lines)
        if fragments:
            columns = [pa.array([r[i] for r in out], pa.string() if i == 3 else pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "number", "start", "record"])

    return lines.mapInArrow(run, schema)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``record``: the text of each record of the files, without headers and blank lines."""
    lines = _lines(spark, path)
    known = spark.sparkContext.broadcast(beginnings([tuple(r) for r in _measured(lines)]))
    inner = _records(lines, known, False)
    pieces = _records(lines, known, True).filter("number > 0").groupBy("file", "number")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "record"))), lambda p: p["record"]), "\n")
    records = inner.unionByName(pieces.agg(joined.alias("record")).select("record"))  # the fragments of one record
    return records.select(F.regexp_replace("record", r"\r$", "").alias("record")).filter("record <> ''")


def read_split_csv(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """The files' records as text columns in the order of ``schema``."""
    parsed = F.from_csv("record", F.lit(schema.toDDL()), {"escape": '"', "multiLine": "true", **options})
    return read_records(spark, path).select(parsed.alias("row")).select("row.*")
