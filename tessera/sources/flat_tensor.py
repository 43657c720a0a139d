"""Flat binary trajectory tensors (SC4-SC8) as a PySpark Python data source.

Layout read (one split of a dataset directory):

* ``{split}_offset.json``: ``{traj: {"position": {"offset": o, "shape": [T, N, dim]},
  "particle_type": {"offset": o}, "step_context": {"offset": o, "shape": [T, g]}}}``
  with *element* offsets into the flat files below; optionally
  ``"file"`` and ``"frame0"`` per tensor (chunked layout written by
  :func:`write_trajectories`).
* ``{split}_position.dat`` float32 row-major ``[T, N, dim]`` blocks,
  ``{split}_particle_type.dat`` int64 ``[N]`` blocks, optional
  ``{split}_step_context.dat`` float32 ``[T, g]`` blocks.

Reads are a bounded ``seek`` + read of exactly the bytes of a frame range,
returned as Arrow batches. In the single-file layout an input partition is one
(trajectory, frame range); the manifest, one small entry per trajectory, is
read on the driver. In the chunked layout an input partition is a byte range of
the JSON-lines manifest, whose entries are read by the task: the driver lists
the manifest files only, and the tasks do not grow with the chunks.
"""

from __future__ import annotations

import json
import os
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "flat_trajectory"
POSITION_SCHEMA = "traj_id int, frame int, particle int, pos array<double>"
TYPE_SCHEMA = "traj_id int, particle int, particle_type long"
CONTEXT_SCHEMA = "traj_id int, frame int, context array<double>"
#: Byte ranges of a chunked manifest: about so many, of no less and no more than these bytes.
RANGES, LEAST_RANGE, MOST_RANGE = 512, 1 << 16, 1 << 20
BATCH_ROWS = 10_000
OPEN_FILES = 16


def load_manifest(path: str, split: str) -> dict[int, dict]:
    """SC4: manifest with string keys cast to int. Chunked manifests (JSON
    lines, one chunk per line) are merged into ``chunks`` lists."""
    single = os.path.join(path, f"{split}_offset.json")
    if os.path.exists(single):
        with open(single) as f:
            raw = json.load(f)
        return {int(k): v for k, v in raw.items()}
    out: dict[int, dict] = {}
    mdir = os.path.join(path, f"{split}_manifest")
    for name in sorted(os.listdir(mdir)):
        if not name.endswith(".json"):
            continue
        with open(os.path.join(mdir, name)) as f:
            for line in f:
                if line.strip():
                    e = json.loads(line)
                    out.setdefault(int(e["traj_id"]), {"chunks": []})["chunks"].append(e)
    return out


class _Part(InputPartition):
    def __init__(self, traj: int, file: str, offset: int, frame0: int, nframes: int, n: int, width: int):
        self.traj, self.file, self.offset = traj, file, offset
        self.frame0, self.nframes, self.n, self.width = frame0, nframes, n, width


class _Range(InputPartition):
    """The lines of a manifest file that begin in ``[first, last)``."""

    def __init__(self, file: str, first: int, last: int):
        self.file, self.first, self.last = file, first, last

    def entries(self):
        with open(self.file, "rb") as f:
            if self.first:
                f.seek(self.first - 1)
                f.readline()  # the line that an earlier range began
            while f.tell() < self.last:
                line = f.readline()
                if not line:
                    return
                if line.strip():
                    yield json.loads(line)


class FlatTrajectoryReader(DataSourceReader):
    def __init__(self, options: dict, kind: str):
        self.path = options["path"]
        self.split = options.get("split", "train")
        self.frames_per_partition = int(options.get("framesPerPartition", "256"))
        self.kind = kind

    def _entries(self):
        for traj, e in sorted(load_manifest(self.path, self.split).items()):
            yield traj, {
                "position_file": os.path.join(self.path, f"{self.split}_position.dat"),
                "position_offset": e["position"]["offset"],
                "frame0": 0,
                "T": e["position"]["shape"][0],
                "N": e["position"]["shape"][1],
                "dim": e["position"]["shape"][2],
                "type_file": os.path.join(self.path, f"{self.split}_particle_type.dat"),
                "type_offset": e["particle_type"]["offset"],
                "context_file": os.path.join(self.path, f"{self.split}_step_context.dat")
                if "step_context" in e and os.path.exists(os.path.join(self.path, f"{self.split}_step_context.dat"))
                else None,
                "context_offset": e.get("step_context", {}).get("offset"),
                "g": (e.get("step_context", {}).get("shape") or [0, 0])[1],
            }

    def _parts(self, traj: int, c: dict):
        """The bounded reads of one trajectory or chunk."""
        if self.kind == "particle_type":
            if c.get("type_file") and c["frame0"] == 0:
                yield _Part(traj, c["type_file"], c["type_offset"], 0, 1, c["N"], 1)
            return
        if self.kind == "context":
            if not c.get("context_file"):
                return
            file, off, width = c["context_file"], c["context_offset"], c["g"]
            per_frame = width
        else:
            file, off, width = c["position_file"], c["position_offset"], c["dim"]
            per_frame = c["N"] * width
        for s in range(0, c["T"], self.frames_per_partition):
            k = min(self.frames_per_partition, c["T"] - s)
            yield _Part(traj, file, off + s * per_frame, c["frame0"] + s, k, c["N"], width)

    def _ranges(self) -> list[_Range]:
        mdir = os.path.join(self.path, f"{self.split}_manifest")
        files = [os.path.join(mdir, name) for name in sorted(os.listdir(mdir)) if name.endswith(".json")]
        sizes = [os.path.getsize(f) for f in files]
        step = min(MOST_RANGE, max(LEAST_RANGE, sum(sizes) // RANGES))
        return [_Range(f, at, min(at + step, size)) for f, size in zip(files, sizes) for at in range(0, size, step)]

    def partitions(self):
        if os.path.exists(os.path.join(self.path, f"{self.split}_offset.json")):
            parts = [p for traj, c in self._entries() for p in self._parts(traj, c)]
        else:
            parts = self._ranges()
        return parts or [_Part(-1, "", 0, 0, 0, 0, 0)]

    def read(self, p: InputPartition):
        if not isinstance(p, _Range):
            opened: dict = {}
            try:
                yield from self._read_part(p, opened)
            finally:
                for f in opened.values():
                    f.close()
            return
        held, rows, opened = [], 0, {}  # small chunks make one batch
        try:
            for e in p.entries():
                for part in self._parts(int(e["traj_id"]), e):
                    for batch in self._read_part(part, opened):
                        held.append(batch)
                        rows += batch.num_rows
                        if rows >= BATCH_ROWS:
                            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                            held, rows = [], 0
            if held:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
        finally:
            for f in opened.values():
                f.close()

    def _read_part(self, p: _Part, opened: dict):
        if p.traj < 0 or p.nframes == 0:
            return
        if self.kind == "particle_type":
            arr = _read(opened, p.file, np.int64, p.offset, p.n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(p.n, p.traj, np.int32)), pa.array(np.arange(p.n, dtype=np.int32)), pa.array(arr)],
                names=["traj_id", "particle", "particle_type"],
            )
            return
        if self.kind == "context":
            arr = _read(opened, p.file, np.float32, p.offset, p.nframes * p.width).astype(np.float64)
            vals = pa.ListArray.from_arrays(pa.array(np.arange(0, arr.size + 1, p.width, dtype=np.int32)), pa.array(arr))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(p.nframes, p.traj, np.int32)), pa.array(np.arange(p.frame0, p.frame0 + p.nframes, dtype=np.int32)), vals],
                names=["traj_id", "frame", "context"],
            )
            return
        count = p.nframes * p.n
        arr = _read(opened, p.file, np.float32, p.offset, count * p.width).astype(np.float64)
        frames = np.repeat(np.arange(p.frame0, p.frame0 + p.nframes, dtype=np.int32), p.n)
        particles = np.tile(np.arange(p.n, dtype=np.int32), p.nframes)
        pos = pa.ListArray.from_arrays(pa.array(np.arange(0, arr.size + 1, p.width, dtype=np.int32)), pa.array(arr))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(count, p.traj, np.int32)), pa.array(frames), pa.array(particles), pos],
            names=["traj_id", "frame", "particle", "pos"],
        )


def _read(opened: dict, file: str, dtype, offset: int, count: int) -> np.ndarray:
    """Bounded read of ``count`` elements at element ``offset``; up to ``OPEN_FILES`` files stay in ``opened``."""
    item = np.dtype(dtype).itemsize
    if file not in opened:
        if len(opened) >= OPEN_FILES:
            opened.pop(next(iter(opened))).close()
        opened[file] = open(file, "rb")
    opened[file].seek(offset * item)
    data = np.fromfile(opened[file], dtype=dtype, count=count)
    if data.size != count:
        raise ValueError(f"{file}: expected {count} elements at {offset}, got {data.size}")
    return data


class FlatTrajectorySource(DataSource):
    """``spark.read.format("flat_trajectory").option("path", p).option("split", s)``;
    ``option("kind", "position" | "particle_type" | "context")``."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        kind = self.options.get("kind", "position")
        return {"position": POSITION_SCHEMA, "particle_type": TYPE_SCHEMA, "context": CONTEXT_SCHEMA}[kind]

    def reader(self, schema):
        return FlatTrajectoryReader(self.options, self.options.get("kind", "position"))


def register(spark: SparkSession) -> None:
    from tessera.session import ship_package

    ship_package(spark)
    spark.dataSource.register(FlatTrajectorySource)


def read_positions(spark: SparkSession, path: str, split: str = "train", frames_per_partition: int = 256) -> DataFrame:
    """SC5: long position rows ``(traj_id, frame, particle, pos)``."""
    if not os.path.isdir(path):
        raise ValueError(f"{path} is not a directory")
    register(spark)
    return (
        spark.read.format(FORMAT).option("path", path).option("split", split)
        .option("framesPerPartition", str(frames_per_partition)).option("kind", "position").load()
    )


def read_particle_types(spark: SparkSession, path: str, split: str = "train") -> DataFrame:
    register(spark)
    return spark.read.format(FORMAT).option("path", path).option("split", split).option("kind", "particle_type").load()


def read_context(spark: SparkSession, path: str, split: str = "train") -> DataFrame:
    """SC6: per-frame global context; empty when the split has none."""
    register(spark)
    return spark.read.format(FORMAT).option("path", path).option("split", split).option("kind", "context").load()


def read_test_split(spark: SparkSession, path: str) -> DataFrame:
    """SC7: the single-split handler always reads the ``test`` files and
    requires a directory."""
    return read_positions(spark, path, "test")


def read_trajectories(spark: SparkSession, path: str, split: str = "train") -> DataFrame:
    """SC8 + JN5: whole-trajectory scan in long form, each position row joined
    with its particle's static type and (left) with the frame context."""
    pos = read_positions(spark, path, split)
    types = read_particle_types(spark, path, split)
    ctx = read_context(spark, path, split)
    return pos.join(types, ["traj_id", "particle"], "left").join(ctx, ["traj_id", "frame"], "left")


# ---------------------------------------------------------------------------
# Writer: chunked layout, one file per task, which holds its (trajectory, frame chunk) blocks one after the other


class _File:
    """A file of this attempt of a task, made for its first rows."""

    def __init__(self, folder: str):
        self.folder, self.name, self.at, self.f = folder, None, 0, None

    def open(self) -> None:
        if self.f is None:
            os.makedirs(self.folder, exist_ok=True)
            self.name = os.path.join(self.folder, f"part-{uuid.uuid4().hex}.dat")
            self.f = open(self.name, "wb")

    def write(self, values: np.ndarray) -> None:
        values.tofile(self.f)
        self.at += values.size

    def close(self) -> None:
        if self.f is not None:
            self.f.close()


def _runs(keys: list[np.ndarray]) -> list[tuple[int, int]]:
    """Where equal neighbours in ``keys`` begin and end."""
    n = len(keys[0])
    cut = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1 if n > 1 else np.zeros(0, int)
    edges = [0, *cut.tolist(), n]
    return list(zip(edges[:-1], edges[1:])) if n else []


def _whole(column: pa.Array, what: str) -> np.ndarray:
    if column.null_count:
        raise ValueError(f"a trajectory cannot be written: {what} is NULL")
    return column.to_numpy(zero_copy_only=False)


def _write_positions(folder: str):
    """Sorted ``(traj_id, chunk, frame, particle, pos)`` rows to a file; one manifest row for each chunk."""

    def each(batches):
        out = _File(folder)
        made: list[tuple] = []
        now = None  # the chunk at hand: traj, chunk, offset, dim; its frames and particles
        frames: list[np.ndarray] = []
        particles: list[np.ndarray] = []

        def close() -> None:
            if now is None:
                return
            traj, chunk, at, dim = now
            f, p = np.concatenate(frames), np.concatenate(particles)
            t, n = len(np.unique(f)), len(np.unique(p))
            if len(f) != t * n or f[-1] - f[0] + 1 != t:
                raise ValueError(f"trajectory {traj} chunk {chunk} is not dense")
            made.append((traj, chunk, out.name, at, int(f[0]), t, n, dim))

        def batch() -> pa.RecordBatch:
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
            names = ["traj_id", "chunk", "position_file", "position_offset", "frame0", "T", "N", "dim"]
            rows = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=names)
            made.clear()
            return rows

        try:
            for b in batches:
                if not b.num_rows:
                    continue
                out.open()
                traj, chunk, frame, particle = (_whole(b.column(i), c) for i, c in enumerate(["traj_id", "frame", "frame", "particle"]))
                widths = _whole(pc.list_value_length(b.column(4)), "pos")
                flat = b.column(4).flatten().to_numpy(zero_copy_only=False).astype(np.float32)
                before = out.at
                ends = np.concatenate([[0], np.cumsum(widths)])
                for i, j in _runs([traj, chunk]):
                    if now is None or now[:2] != (traj[i], chunk[i]):
                        close()
                        now, frames, particles = (int(traj[i]), int(chunk[i]), before + int(ends[i]), int(widths[i])), [], []
                    if (widths[i:j] != now[3]).any():
                        raise ValueError(f"trajectory {now[0]} chunk {now[1]} has positions of different length")
                    frames.append(frame[i:j])
                    particles.append(particle[i:j])
                out.write(flat)
                if len(made) >= BATCH_ROWS:
                    yield batch()
            close()
        finally:
            out.close()
        if made:
            yield batch()

    return each


def _write_types(folder: str):
    """Sorted ``(traj_id, particle_type)`` rows to a file; one row for each trajectory."""

    def each(batches):
        out = _File(folder)
        made: list[tuple] = []
        now = None
        try:
            for b in batches:
                if not b.num_rows:
                    continue
                out.open()
                traj = _whole(b.column(0), "traj_id")
                before = out.at
                out.write(b.column(1).to_numpy(zero_copy_only=False).astype(np.int64))
                for i, _ in _runs([traj]):
                    if traj[i] != now:
                        now = traj[i]
                        made.append((int(now), out.name, before + i))
        finally:
            out.close()
        if made:
            kinds = [pa.int32(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=["traj_id", "type_file", "type_offset"])

    return each


def write_trajectories(df: DataFrame, path: str, split: str = "train", frames_per_chunk: int = 1024,
                       particle_type: DataFrame | None = None) -> None:
    """Write dense ``(traj_id, frame, particle, pos)`` rows as float32 blocks
    plus a JSON-lines manifest, from the executors: every task sorts its
    (trajectory, frame chunk) blocks and streams them into one file, so files
    and Python calls grow with the tasks and not with the trajectories.
    ``particle_type``: optional ``(traj_id, particle, particle_type)``."""
    from tessera.session import ship_package

    ship_package(df.sparkSession)
    rows = df.select(
        F.col("traj_id").cast("int").alias("traj_id"), F.floor(F.col("frame") / F.lit(frames_per_chunk)).cast("int").alias("__chunk"),
        "frame", "particle", F.col("pos").cast("array<double>").alias("pos"),
    )
    placed = rows.repartition("traj_id", "__chunk").sortWithinPartitions("traj_id", "__chunk", "frame", "particle")
    man_schema = "traj_id int, chunk int, position_file string, position_offset long, frame0 int, T int, N int, dim int"
    manifest = placed.mapInArrow(_write_positions(os.path.join(path, f"{split}_position")), man_schema)
    if particle_type is not None:
        by_traj = particle_type.select(F.col("traj_id").cast("int").alias("traj_id"), "particle", "particle_type")
        by_traj = by_traj.repartition("traj_id").sortWithinPartitions("traj_id", "particle").select("traj_id", "particle_type")
        types = by_traj.mapInArrow(
            _write_types(os.path.join(path, f"{split}_particle_type")), "traj_id int, type_file string, type_offset long"
        )
        manifest = manifest.join(types, "traj_id", "left")
    manifest.write.mode("overwrite").json(os.path.join(path, f"{split}_manifest"))


MANIFEST_SCHEMA = (
    "map<string, struct<position: struct<offset: bigint, shape: array<int>>, "
    "particle_type: struct<offset: bigint>, step_context: struct<offset: bigint, shape: array<int>>>>"
)


def manifest_table(spark: SparkSession, path: str, split: str = "train") -> DataFrame:
    """SC4 as a DataFrame: the offsets document read whole, parsed with
    ``from_json`` as a map, exploded, keys cast to int; ``dim`` per trajectory
    from its own shape (quirk Q9)."""
    doc = spark.read.text(os.path.join(path, f"{split}_offset.json"), wholetext=True)
    m = doc.select(F.explode(F.from_json("value", MANIFEST_SCHEMA)).alias("k", "v"))
    return m.select(
        F.col("k").cast("int").alias("traj_id"),
        F.col("v.position.offset").alias("position_offset"),
        F.col("v.position.shape")[0].alias("T"),
        F.col("v.position.shape")[1].alias("N"),
        F.col("v.position.shape")[2].alias("dim"),
        F.col("v.particle_type.offset").alias("type_offset"),
        F.col("v.step_context.offset").alias("context_offset"),
        F.col("v.step_context.shape")[1].alias("context_dim"),
    )
