"""CSV files with line breaks in quotes, read in blocks."""

import csv
import io
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.sources import csv_split as C
from tessera.sources.files import read_csv

SCHEMA = "id long, created_on timestamp, title string, description string, tag string"


@pytest.fixture()
def small_blocks(spark):
    conf = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def write(rows, name="a.csv", end="\n", folder=None):
    folder = folder or tempfile.mkdtemp(prefix="csv-split-")
    text = io.StringIO()
    w = csv.writer(text, lineterminator=end)
    w.writerow(["id", "created_on", "title", "description", "tag"])
    w.writerows(rows)
    with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
        f.write(text.getvalue())
    return folder


def odd_rows(n, seed):
    rng = random.Random(seed)
    bits = ["plain", 'a "quoted" word', "two\nlines", "\n", "x,y", "é中", '"', '""', "end\n\n", " space ", "\\N", "", "tab\t", "\\"]
    return [
        (k, "", "".join(rng.choices(bits, k=rng.randint(0, 4))), "".join(rng.choices(bits, k=rng.randint(0, 30))), rng.choice("abc"))
        for k in range(n)
    ]


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_blocks_give_the_rows_of_the_whole_file(spark, small_blocks):
    folder = write(odd_rows(3000, 1))
    write([(5000 + r[0], *r[1:]) for r in odd_rows(500, 2)], "b.csv", folder=folder)
    got = C.read_csv_split(spark, folder, SCHEMA)
    want = read_csv(spark, folder, SCHEMA)
    states = C.block_states(C._lines(spark, folder)).collect()
    assert len(states) > 10 and any(s.inside for s in states) and not all(s.inside for s in states)
    assert rows_of(got.na.fill("?")) == rows_of(want.na.fill("?"))
    assert got.count() == 3500
    busy = C.csv_records(spark, folder).select("start").distinct().count()
    assert busy > 10


def test_a_record_over_many_blocks(spark, small_blocks):
    long = "line of a long field\n" * 6000  # about six blocks
    rows = [(1, "", "t", "before", "a"), (2, "", "t", long, "b"), (3, "", "t", "after\nit", "c"), (4, "", long, long, "d")]
    folder = write(rows)
    got = {r.id: (r.title, r.description, r.tag) for r in C.read_csv_split(spark, folder, SCHEMA).collect()}
    assert got == {r[0]: r[2:] for r in rows}


def test_line_ends_of_two_signs(spark, small_blocks):
    rows = [(k, "", f"t{k}", "one\r\ntwo" if k % 3 else "x" * 500, "a") for k in range(300)]
    folder = write(rows, end="\r\n")
    got = C.csv_records(spark, folder)
    assert got.count() == 300 and got.where(F.col("record").endswith("\r")).count() == 0


def test_empty_files(spark):
    assert C.read_csv_split(spark, write([]), SCHEMA).collect() == []
    folder = tempfile.mkdtemp(prefix="csv-split-")
    open(os.path.join(folder, "empty.csv"), "w").close()
    assert C.read_csv_split(spark, folder, SCHEMA).collect() == []
