"""CSV records that span lines and splits, against Spark's reader of whole files."""

import csv
import random
from contextlib import contextmanager

import pytest

from audience_engine.sources import readers
from audience_engine.sources.split_csv import beginnings


@contextmanager
def split_size(spark, size):
    names = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}
    before = {n: spark.conf.get(n) for n in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def write(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as file:
        out = csv.writer(file, lineterminator=end)
        out.writerow(["id", "te xt", "note,`s"])
        out.writerows(rows)


def some_rows(seed, n):
    draw = random.Random(seed)
    bits = ["plain", "with, comma", 'say "so"', "two\nlines", 'a "b"\n\n"c",\n', "", "é中", "\n", "cr\r\nlf", '""', "x" * 300 + "\n" * 5]
    return [[str(i), "".join(draw.choice(bits) for _ in range(draw.randrange(4))), draw.choice(bits)] for i in range(n)]


@pytest.mark.parametrize(("seed", "size", "end"), [(1, 97, "\n"), (2, 700, "\r\n"), (3, 5000, "\n"), (4, 40, "\n")])
def test_split_reading_equals_one_task(spark, tmp_path, seed, size, end):
    for k in range(2):
        write(tmp_path / f"part{k}.csv", some_rows(seed + 10 * k, 150 if size > 50 else 25), end)
    write(tmp_path / "part9.csv", [])
    whole = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path))
    with split_size(spark, size):
        split = readers.read_texts_csv(spark, str(tmp_path))
        assert split.columns == whole.columns and split.rdd.getNumPartitions() > 4
        got = sorted(map(tuple, split.collect()), key=repr)
    given = [r for k in range(2) for r in some_rows(seed + 10 * k, 150 if size > 50 else 25)]
    assert got == sorted((tuple(c or None for c in r) for r in given), key=repr)
    if end == "\n":  # else that reader shortens line ends inside quotes
        assert got == sorted(map(tuple, whole.collect()), key=repr)


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path):
    text = "A long text, with \"marks\"\nand lines. " * 40
    write(tmp_path / "large.csv", [[str(i), text, "n"] for i in range(12_000)])  # some 18 MB
    with split_size(spark, 1 << 20):
        rows = readers.read_texts_csv(spark, str(tmp_path / "large.csv"))
        assert rows.rdd.getNumPartitions() >= 15
        got = rows.selectExpr("count(*)", "count(DISTINCT id)", "count(DISTINCT `te xt`)").first()
        assert tuple(got) == (12_000, 12_000, 1)
        assert rows.select("te xt").first()[0] == text


def test_bad_records_and_empty_files(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('id,text\n1,"a\nb"\n2,c,extra\n\n3,"open\nto the end\n')
    with split_size(spark, 8):
        rows = readers.read_texts_csv(spark, str(tmp_path / "bad.csv"), keep_bad=True).collect()
    assert {r.id for r in rows} == {"1", "2", "3"}
    assert [r[readers.BAD_RECORD] for r in rows if r.id == "2"] == ["2,c,extra"]
    (tmp_path / "empty.csv").write_text("")
    assert readers.read_texts_csv(spark, str(tmp_path / "empty.csv")).count() == 0


def test_beginnings():
    splits = [(1, 0, 3, 1, 2), (1, 10, 2, 0, 1), (1, 20, 4, 1, 1), (2, 0, 5, 0, 5), (2, 10, 1, 0, 1)]
    assert beginnings(splits[::-1]) == {(1, 0): (0, 0), (1, 10): (1, 2), (1, 20): (1, 3), (2, 0): (0, 0), (2, 10): (0, 5)}
