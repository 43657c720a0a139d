"""Splitting CSV files whose quoted fields hold line breaks (SC1).

Spark reads such a file whole, in one task. Here it is read as lines by byte
blocks, in as many tasks as it has blocks:

1. Each block counts its quotes. An odd count flips whether the next block
   starts inside a quoted field, so the parity of all blocks before is the
   state in which a block begins.
2. Each block joins its lines to records, from that state on. What a block
   ends with but does not finish, and what it begins with that an earlier one
   started, are fragments.
3. Fragments of a record meet by the block in which it starts. Records are
   parsed by Spark's CSV functions.

Quotes inside a field are doubled (RFC 4180): a quote that is neither around a
field nor doubled inside one, or is escaped by another sign, would be miscounted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.sources.files import CSV_OPTS, LABELLED_SCHEMA

WHOLE, BEGIN, MIDDLE, FINISH = range(4)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``(value, file, start)``: lines without their line feed, in order within a block."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )


def block_states(lines: DataFrame) -> DataFrame:
    """``(file, start, inside)``: whether a block starts inside a quoted field; one row for each block."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("file", "start", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"))


def _joined(lines: DataFrame, states: DataFrame, header: bool) -> DataFrame:
    """``(file, start, kind, record)``: whole records, and at most two fragments of each block."""
    # eight bytes for each block that starts inside a field: 8 MB for a million blocks, that is 128 TB in blocks of 128 MB
    inside = states.where("inside").select(F.xxhash64("file", "start")).collect()
    opened = lines.sparkSession.sparkContext.broadcast(np.sort(np.array([r[0] for r in inside], np.int64)))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = opened.value
        now = None  # the block: file, start
        held: list[str] = []  # lines of the record at hand
        odd = carried = skip = False
        out: list[tuple] = []

        def emit(kind: int) -> None:
            nonlocal skip
            if skip and kind in (WHOLE, BEGIN):
                skip = False
                if kind == WHOLE:
                    return
            out.append((*now, kind, "\n".join(held)))

        def close() -> None:
            if now is not None and held:
                emit(MIDDLE if carried else BEGIN)

        def batch() -> pa.RecordBatch:
            cols = zip(*out)
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["file", "start", "kind", "record"])
            out.clear()
            return made

        kinds = [pa.string(), pa.int64(), pa.int32(), pa.string()]
        for b in batches:
            for value, file, start, digest in zip(*(c.to_pylist() for c in b.columns)):
                if (file, start) != now:
                    close()
                    at = np.searchsorted(known, digest)
                    carried = odd = bool(at < len(known) and known[at] == digest)
                    now, held, skip = (file, start), [], header and start == 0
                held.append(value)
                odd ^= value.count('"') % 2 == 1
                if not odd:
                    emit(FINISH if carried else WHOLE)
                    held, carried = [], False
            if len(out) >= 2000:
                yield batch()
        close()
        if out:
            yield batch()

    schema = "file string, start bigint, kind int, record string"
    return lines.select("value", "file", "start", F.xxhash64("file", "start").alias("digest")).mapInArrow(each, schema)


def csv_records(spark: SparkSession, path: str, *, header: bool = True) -> DataFrame:
    """``(file, start, record)``: the text of every record but headers, ``start`` being the block in which it begins.

    Empty lines outside quotes are no records. A record must fit into the memory
    of a task, a file need not. A quote that is never closed makes the rest of
    its file one record.
    """
    lines = _lines(spark, path)
    parts = _joined(lines, block_states(lines), header)
    whole = parts.where(F.col("kind") == WHOLE).select("file", "start", "record")
    # of the fragments of a file, those up to the next beginning belong together
    upto = Window.partitionBy("file").orderBy("start", "kind_order").rowsBetween(Window.unboundedPreceding, 0)
    order = F.when(F.col("kind") == BEGIN, 1).otherwise(0)  # what a block finishes stands before what it begins
    cut = parts.where(F.col("kind") != WHOLE).withColumn("kind_order", order)
    begun = cut.withColumn("begun", F.last(F.when(F.col("kind") == BEGIN, F.col("start")), ignorenulls=True).over(upto))
    glued = begun.where("begun IS NOT NULL").groupBy("file", "begun").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "record"))), lambda x: x.record), "\n").alias("record")
    )
    both = whole.unionByName(glued.select("file", F.col("begun").alias("start"), "record"))
    text = F.when(F.col("record").endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return both.withColumn("record", text).where("record <> ''")


def read_csv_split(spark: SparkSession, path: str, schema: str = LABELLED_SCHEMA) -> DataFrame:
    """SC1: as :func:`tessera.sources.files.read_csv`, with every file read in blocks by many tasks.

    ``path`` may be on any file system Spark reads. Rows come in no order.
    Malformed records give NULL fields, as Spark's permissive reader does.
    """
    opts = {k: v for k, v in CSV_OPTS.items() if k not in ("header",)}
    return csv_records(spark, path).select(F.from_csv("record", F.lit(schema), opts).alias("r")).select("r.*")
