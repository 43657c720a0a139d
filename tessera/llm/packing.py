"""Best-fit packing by exact-complement hashing.

Documents become token pieces in one pass. What fits with what depends on the
lengths alone, so the plan is made from the histogram of piece lengths (at most
``capacity`` numbers, whatever the size of the corpus): for the longest length
left, the sums of one, two and three available lengths are looked up for an
exact filling of the gap, and such a combination is used as often as the counts
allow; where none fits, the longest length that fits is taken and the smaller
gap tried again. The plan is a list of rank ranges per length. Spark ranks the
pieces of a length in buckets and looks each rank up in the plan.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, prepare

CAPACITY = 4096
END_ID = 1
#: Pieces of one length and bucket: what one window partition sorts.
BUCKET_ROWS = 50_000
#: Words, and texts between blanks, whose ids a worker remembers.
CACHE_WORDS = 600_000

#: The pre-tokenizer's pattern, fixed by the tokenizer file.
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Texts of these characters are cut into parts alike before and after the
#: tokenizer's normalization; others go to the tokenizer as they are.
_PLAIN = re.compile("[\t\n\r\x0b\x0c -įı-ɏ‐-‧€]*")


def vocabulary_path() -> str:
    """The public tokenizer file of the contract, where this machine has it."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    The tokenizer works on each part (word, digit, run of signs) alone, so the
    ids of a text are those of its parts in a row. What stands between blanks is
    remembered with its ids, and so is each part.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        ends = [i for w, i in self.tokenizer.get_vocab().items() if w.endswith("</w>")]
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[ends] = True
        self.parts: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _encode(self, parts: list[str]) -> dict[str, bytes]:
        made = {}
        for k in range(0, len(parts), 5000):
            some = parts[k : k + 5000]
            (line,) = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)
            ids = np.array(line.ids, "<u4")
            last = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            raw = ids.tobytes()
            if len(last) == len(some):
                made.update(zip(some, [raw[i:j] for i, j in zip([0, *last], last)]))
            else:
                made.update((w, self._whole(w)) for w in some)
        return made

    def _fill(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of chunks that are not remembered; remembers as many as there is room for."""
        cut, get = [_PARTS.findall(c) for c in chunks], self.parts.get
        found = [list(map(get, parts)) for parts in cut]
        new = self._encode(list({w: None for parts, ids in zip(cut, found) if None in ids for w, i in zip(parts, ids) if i is None}))
        made = {
            c: b"".join([new[w] if i is None else i for w, i in zip(parts, ids)] if None in ids else ids)
            for c, parts, ids in zip(chunks, cut, found)
        }
        for known, more in ((self.parts, new), (self.chunks, made)):
            if len(known) < CACHE_WORDS:  # common words come early
                known.update(more)
        return made

    def __call__(self, texts: list[str]) -> list[bytes]:
        cut = [t.lower().replace("\n", " ").split(" ") if "<|" not in t and _PLAIN.fullmatch(t) else None for t in texts]
        get = self.chunks.get
        found = [None if c is None else list(map(get, c)) for c in cut]
        gaps = [k for k, f in enumerate(found) if f and None in f]
        if gaps:
            new = self._fill(list({c: None for k in gaps for c, ids in zip(cut[k], found[k]) if ids is None}))
            for k in gaps:
                found[k] = [new[c] if ids is None else ids for c, ids in zip(cut[k], found[k])]
        return [self._whole(t) if f is None else b"".join(f) for t, f in zip(texts, found)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, piece, start, length, ids_crc32): documents cut at ``capacity`` tokens.

    A document's ids end with ``END_ID``, so an empty or null text is one piece
    of length one.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, step = encoder(path), np.array([END_ID], "<u4").tobytes(), 4 * capacity
        for b in batches:
            row, piece, length, crc = [], [], [], []
            for k, ids in enumerate(encode([t or "" for t in b.column(1).to_pylist()])):
                ids += end
                for i in range(0, len(ids), step):
                    part = ids[i : i + step]
                    row.append(k)
                    piece.append(i // step)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            number = pa.array(piece, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int32())), number, pa.array(np.array(piece, np.int64) * capacity), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=[id_col, "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(id_col, text_col).mapInArrow(
        each, f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


def _times(parts: list[int], left: np.ndarray) -> int:
    """How often the combination can be taken."""
    return min(int(left[x]) // parts.count(x) for x in set(parts))


def _pair(gap: int, taken: list[int], left: np.ndarray) -> list[int] | None:
    """Two available lengths that sum to ``gap``, the first as long as possible."""
    a = np.arange(gap - 1, (gap - 1) // 2, -1)
    for x in a[(left[a] > 0) & (left[gap - a] > 0)].tolist():
        if _times([*taken, x, gap - x], left):
            return [x, gap - x]
    return None


def _exact(gap: int, taken: list[int], left: np.ndarray) -> list[int] | None:
    """One, two or three available lengths that sum to ``gap``."""
    if left[gap] and _times([*taken, gap], left):
        return [gap]
    if gap > 1 and (found := _pair(gap, taken, left)):
        return found
    for x in np.flatnonzero(left[: max(0, gap - 1)])[::-1].tolist():
        if 3 * x < gap:  # the longest of three is a third at least
            return None
        if _times([*taken, x], left) and (found := _pair(gap - x, [*taken, x], left)):
            return [x, *found]
    return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """(how many sequences, their lengths) for a histogram of lengths.

    Takes memory and steps by the number of different lengths, not of pieces.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out = []
    for top in range(capacity, 0, -1):
        while left[top]:
            parts, gap = [top], capacity - top
            while gap:
                if found := _exact(gap, parts, left):
                    parts += found
                    break
                fits = [x for x in np.flatnonzero(left[: gap + 1])[::-1].tolist() if _times([*parts, x], left)][:1]
                if not fits:
                    break
                parts += fits
                gap -= fits[0]
            n = _times(parts, left)
            for x in parts:
                left[x] -= n
            out.append((n, parts))
    return out


def _ranges(made: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    """The plan by length and rank: rows (length, first rank, first sequence, offset), sorted."""
    rows, used, sequence = [], {}, 0
    for n, parts in made:
        offset = 0
        for x in parts:
            rows.append((x, used.get(x, 0), sequence, offset))
            used[x] = used.get(x, 0) + n
            offset += x
        sequence += n
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 4).T
    return {"key": (cols[0] << 48) + cols[1], "rank": cols[1], "sequence": cols[2], "offset": cols[3]}


def ranked(made: DataFrame, order: list[str]) -> DataFrame:
    """``made`` with a gapless ``rank`` from 0 within each ``length``.

    Pieces are ranked within hash buckets, and a bucket begins where those
    before it end, so a length that many pieces share is ranked in many tasks.
    """
    most = made.groupBy("length").count().agg(F.max("count")).first()[0] or 1
    buckets = -(-most // BUCKET_ROWS)
    dealt = made.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*order))
    numbered = dealt.withColumn("within", within)
    return numbered.join(begins, ["length", "bucket"]).withColumn("rank", F.col("begin") + F.col("within") - 1)


def pack(
    docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of ``docs`` with the sequence that each goes to and its place there.

    * Null or empty text: one piece, the end id alone.
    * Documents above ``capacity`` tokens: pieces of ``capacity``, the last may be shorter.
    * Repeated rows and null ids: each row is packed on its own.
    * An empty table gives no rows; other columns are not read.
    """
    prepare(docs.sparkSession)
    made = materialize(pieces(docs, path, capacity, id_col, text_col))
    counts = {r["length"]: r["count"] for r in made.groupBy("length").count().collect()}  # capacity rows at most
    where = docs.sparkSession.sparkContext.broadcast(_ranges(plan(counts, capacity)))
    names = [id_col, "piece", "start", "length", "ids_crc32"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = where.value
        for b in batches:
            length, rank = (b.column(k).to_numpy().astype(np.int64) for k in (3, 5))
            at = np.searchsorted(p["key"], (length << 48) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(p["sequence"][at] + rank - p["rank"][at]), pa.array(p["offset"][at])],
                names=[*names, "sequence_id", "offset"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return ranked(made, [id_col, "piece", "ids_crc32"]).select(*names, "rank").mapInArrow(
        place,
        f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    )
