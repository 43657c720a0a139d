"""Trajectory tensors on any file system (SC4, SC5, SC8).

A store folder holds, for each split, data files, one index file beside each,
and one commit file per finished write that names its index files. Readers see
only what commit files name, so a write that fails or still runs is invisible.

* ``<split>/data/part-<id>.dat``: blocks of (trajectory, chunk): positions as
  float32 ``[T, N, dim]``, particle ids as int64 ``[N]``, and particle types as
  int64 ``[N]``; every chunk carries its own ids and types.
* ``<split>/data/part-<id>.json``: a line for each block (``INDEX_SCHEMA``).
* ``<split>/commits/<id>.json``: the parts of a write.

Reading is planned as a table: the index lines become byte ranges of about
``BYTES_PER_READ`` each, the ranges are dealt over tasks, and a task reads its
ranges with positioned reads. The flat single-file layout is read in the same
way (:func:`flat_index`). Bytes go through ``pyarrow.fs``: local paths,
``file:``, ``hdfs:`` and ``viewfs:`` (Hadoop's client library), object stores.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tessera.sources.flat_tensor import manifest_table

FORMAT = "trajectory_store"
#: Bytes of positions that one read asks for.
BYTES_PER_READ = 8 << 20
INDEX_SCHEMA = (
    "traj_id long, chunk long, file string, position_at long, ids_at long, types_at long, frame0 long, T long, N long, dim int"
)
ROW_SCHEMA = "traj_id long, frame long, particle long, particle_type long, pos array<double>"


def file_system(path: str):
    """The file system of ``path`` and the path on it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class PartWritten(WriterCommitMessage):
    part: str
    blocks: int


class _Part:
    """One task's data file; rows come sorted by trajectory, chunk, frame and particle."""

    def __init__(self, folder: str):
        self.fs, base = file_system(folder)
        self.name = f"part-{uuid.uuid4().hex}"
        self.base = f"{base}/{self.name}"
        self.fs.create_dir(base)
        self.out = self.fs.open_output_stream(f"{self.base}.dat")
        self.at, self.lines = 0, []

    def put(self, array: np.ndarray) -> int:
        place = self.at
        self.out.write(array.tobytes())
        self.at += array.nbytes
        return place

    def block(self, traj: int, chunk: int, frames: np.ndarray, ids: np.ndarray, types: np.ndarray, pos: np.ndarray) -> None:
        first = np.flatnonzero(frames == frames[0])
        n, total = len(first), len(frames)
        count = total // n
        whole = n * count == total and (frames == np.repeat(frames[0] + np.arange(count), n)).all()
        if not whole or (ids.reshape(count, n) != ids[:n]).any() or len(np.unique(ids[:n])) != n:
            raise ValueError(f"trajectory {traj}, chunk {chunk}: each frame needs the same particles once, and frames no gap")
        if (types.reshape(count, n) != types[:n]).any():
            raise ValueError(f"trajectory {traj}, chunk {chunk}: a particle changes its type")
        entry = {"traj_id": traj, "chunk": chunk, "file": f"{self.name}.dat", "frame0": int(frames[0]), "T": count, "N": n, "dim": pos.shape[1]}
        entry["position_at"] = self.put(pos.astype("<f4"))
        entry["ids_at"], entry["types_at"] = self.put(ids[:n].astype("<i8")), self.put(types[:n].astype("<i8"))
        self.lines.append(json.dumps(entry))

    def close(self) -> PartWritten:
        self.out.close()
        with self.fs.open_output_stream(f"{self.base}.json") as f:
            f.write("".join(line + "\n" for line in self.lines).encode())
        return PartWritten(self.name, len(self.lines))

    def drop(self) -> None:
        self.out.close()
        remove(self.fs, self.base)


def remove(fs, base: str) -> None:
    from pyarrow.fs import FileType

    for end in (".dat", ".json"):
        if fs.get_file_info(base + end).type != FileType.NotFound:
            fs.delete_file(base + end)


class TrajectoryWriter(DataSourceArrowWriter):
    """Tasks write parts, the commit names them; a failed task or job removes what it wrote."""

    def __init__(self, options: dict):
        self.root = f"{options['path'].rstrip('/')}/{options.get('split', 'train')}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> PartWritten:
        part, held, now = None, [], None
        try:
            part = _Part(f"{self.root}/data")

            def close() -> None:
                if held:
                    cols = [np.concatenate([h[k] for h in held]) for k in range(4)]
                    part.block(*now, *cols)
                    held.clear()

            for b in iterator:
                traj, chunk, frame, ids, types = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("traj_id", "chunk", "frame", "particle", "particle_type"))
                listed = b.column(b.schema.get_field_index("pos"))
                dim = len(listed[0]) if b.num_rows else 0
                flat = listed.flatten().to_numpy()
                if len(flat) != dim * b.num_rows:
                    raise ValueError("positions of one length are needed")
                starts = np.flatnonzero(np.r_[True, (traj[1:] != traj[:-1]) | (chunk[1:] != chunk[:-1])]) if b.num_rows else []
                for s, e in zip(starts, [*starts[1:], b.num_rows]):
                    if (key := (int(traj[s]), int(chunk[s]))) != now:
                        close()
                        now = key
                    held.append((frame[s:e], ids[s:e], types[s:e], flat.reshape(-1, dim)[s:e]))
            close()
            return part.close()
        except BaseException:
            if part is not None:
                part.drop()
            raise

    def commit(self, messages: list[PartWritten | None]) -> None:
        fs, base = file_system(f"{self.root}/commits")
        fs.create_dir(base)
        name = uuid.uuid4().hex
        with fs.open_output_stream(f"{base}/.{name}") as f:  # hidden until it is whole
            f.write(json.dumps({"parts": [m.part for m in messages if m is not None and m.blocks]}).encode())
        fs.move(f"{base}/.{name}", f"{base}/{name}.json")

    def abort(self, messages: list[PartWritten | None]) -> None:
        fs, base = file_system(f"{self.root}/data")
        for m in messages:
            if m is not None:
                remove(fs, f"{base}/{m.part}")


class TrajectoryStore(DataSource):
    """``df.write.format("trajectory_store").option("path", p).option("split", s)``; see :func:`write_store`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ROW_SCHEMA

    def writer(self, schema, overwrite: bool) -> TrajectoryWriter:
        if overwrite:
            raise ValueError("a store is appended to; write to a new folder instead")
        return TrajectoryWriter(self.options)


def write_store(rows: DataFrame, path: str, split: str = "train", frames_per_chunk: int = 1024) -> None:
    """Append dense ``(traj_id, frame, particle, particle_type, pos)`` rows to a store, all or nothing.

    A task holds one (trajectory, chunk) at a time. Each frame of a chunk must
    have the same particles, each once; anything else fails the write, which
    then leaves no file.
    """
    from tessera.session import ship_package

    ship_package(rows.sparkSession)
    rows.sparkSession.dataSource.register(TrajectoryStore)
    kinds = {"traj_id": "long", "chunk": "long", "frame": "long", "particle": "long", "particle_type": "long", "pos": "array<double>"}
    chunked = rows.withColumn("chunk", F.floor(F.col("frame") / F.lit(frames_per_chunk)))
    placed = chunked.select(*[F.col(c).cast(t).alias(c) for c, t in kinds.items()])
    placed = placed.repartition("traj_id", "chunk").sortWithinPartitions("traj_id", "chunk", "frame", "particle")
    placed.write.format(FORMAT).mode("append").option("path", path).option("split", split).save()


def store_index(spark: SparkSession, path: str, split: str = "train") -> DataFrame:
    """SC4: the blocks of all committed writes, ``file`` being a full path."""
    root = f"{path.rstrip('/')}/{split}"
    commits = spark.read.schema("parts array<string>").json(f"{root}/commits/*.json")
    parts = [r[0] for r in commits.select(F.explode("parts")).distinct().collect()]  # a name for each task of a write
    if not parts:
        return spark.createDataFrame([], INDEX_SCHEMA)
    index = spark.read.schema(INDEX_SCHEMA).json([f"{root}/data/{p}.json" for p in sorted(parts)])
    return index.withColumn("file", F.concat(F.lit(f"{root}/data/"), "file"))


def flat_index(spark: SparkSession, path: str, split: str = "train") -> DataFrame:
    """SC4: the flat single-file layout as index lines: one block for each
    trajectory, particles numbered from 0, types in a file of their own."""
    path = path.rstrip("/")
    m = manifest_table(spark, path, split)
    return m.select(
        F.col("traj_id").cast("long").alias("traj_id"), F.lit(0).cast("long").alias("chunk"),
        F.lit(f"{path}/{split}_position.dat").alias("file"), (F.col("position_offset") * 4).alias("position_at"),
        F.lit(None).cast("long").alias("ids_at"), (F.col("type_offset") * 8).alias("types_at"),
        F.lit(0).cast("long").alias("frame0"), F.col("T").cast("long").alias("T"), F.col("N").cast("long").alias("N"), F.col("dim").cast("int").alias("dim"),
        F.lit(f"{path}/{split}_particle_type.dat").alias("types_file"),
    )


def byte_ranges(index: DataFrame, bytes_per_read: int = BYTES_PER_READ) -> DataFrame:
    """Index lines cut into runs of frames of about ``bytes_per_read`` (one frame at least): ``first``, ``frames``."""
    frame_bytes = F.col("N") * F.col("dim") * 4
    step = F.greatest(F.lit(1), F.floor(F.lit(bytes_per_read) / F.greatest(frame_bytes, F.lit(1)))).cast("long")
    cut = index.where("T > 0 AND N > 0").withColumn("step", step)
    cut = cut.withColumn("first", F.explode(F.expr("sequence(0L, T - 1, step)")))
    return cut.withColumn("frames", F.least(F.col("step"), F.col("T") - F.col("first"))).drop("step")


def read_index(index: DataFrame, bytes_per_read: int = BYTES_PER_READ) -> DataFrame:
    """SC5 + SC8: rows ``(traj_id, frame, particle, particle_type, pos)`` of the blocks of ``index``.

    Ranges are dealt over tasks by their hash, so tasks have about as many bytes
    each, whatever the length of a trajectory.
    """
    ranges = byte_ranges(index, bytes_per_read)
    if "types_file" not in ranges.columns:
        ranges = ranges.withColumn("types_file", F.col("file"))
    names = ["traj_id", "file", "position_at", "ids_at", "types_at", "frame0", "N", "dim", "first", "frames", "types_file"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict = {}

        def read(path: str, at: int, count: int, kind: str) -> np.ndarray:
            if path not in opened:
                if len(opened) >= 16:
                    opened.pop(next(iter(opened))).close()
                fs, place = file_system(path)
                opened[path] = fs.open_input_file(place)
            size = count * np.dtype(kind).itemsize
            data = opened[path].read_at(size, at)
            if len(data) != size:
                raise ValueError(f"{path}: {size} bytes at {at} are needed, {len(data)} are there")
            return np.frombuffer(data, kind)

        for b in batches:
            for r in b.to_pylist():
                n, dim, frames = r["N"], r["dim"], r["frames"]
                ids = np.arange(n) if r["ids_at"] is None else read(r["file"], r["ids_at"], n, "<i8")
                types = pa.nulls(n * frames, pa.int64()) if r["types_at"] is None else pa.array(np.tile(read(r["types_file"], r["types_at"], n, "<i8"), frames))
                flat = read(r["file"], r["position_at"] + r["first"] * n * dim * 4, frames * n * dim, "<f4").astype(float)
                rows = n * frames
                frame = np.repeat(r["frame0"] + r["first"] + np.arange(frames), n)
                pos = pa.ListArray.from_arrays(pa.array(np.arange(0, rows * dim + 1, dim, dtype=np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(rows, r["traj_id"])), pa.array(frame), pa.array(np.tile(ids, frames)), types, pos],
                    names=["traj_id", "frame", "particle", "particle_type", "pos"],
                )
        for f in opened.values():
            f.close()

    dealt = ranges.select(*names).repartition("file", "traj_id", "position_at", "first")
    return dealt.mapInArrow(each, ROW_SCHEMA)


def read_store(spark: SparkSession, path: str, split: str = "train") -> DataFrame:
    """All rows of a store's split."""
    return read_index(store_index(spark, path, split))


def read_flat(spark: SparkSession, path: str, split: str = "train") -> DataFrame:
    """All rows of a split in the flat single-file layout."""
    return read_index(flat_index(spark, path, split))


def read_flat_context(spark: SparkSession, path: str, split: str = "train") -> DataFrame:
    """SC6: ``(traj_id, frame, context)`` of the flat layout; no rows where a trajectory has none."""
    path = path.rstrip("/")
    m = manifest_table(spark, path, split).where("context_offset IS NOT NULL")
    index = m.select(
        F.col("traj_id").cast("long").alias("traj_id"), F.lit(f"{path}/{split}_step_context.dat").alias("file"),
        (F.col("context_offset") * 4).alias("position_at"), F.lit(None).cast("long").alias("ids_at"), F.lit(None).cast("long").alias("types_at"),
        F.lit(0).cast("long").alias("frame0"), F.col("T").cast("long").alias("T"), F.lit(1).cast("long").alias("N"), F.col("context_dim").cast("int").alias("dim"),
    )
    return read_index(index).select("traj_id", "frame", F.col("pos").alias("context"))


def read_flat_trajectories(spark: SparkSession, path: str, split: str = "train") -> DataFrame:
    """SC7 + SC8: a split of the flat layout (``split="test"``: the test files) with types and context in each row."""
    return read_flat(spark, path, split).join(read_flat_context(spark, path, split), ["traj_id", "frame"], "left")
