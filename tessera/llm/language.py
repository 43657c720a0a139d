"""Language identification by the nearest of several centroids per language.

A text is a normalised TF-IDF vector of hashed byte n-grams. Document
frequencies are summed over all documents that may be learned from. Each
language's centroids come from a spherical k-means of a bounded sample, one
small task per language. A text takes the language of the centroid with the
largest cosine; a text far from every centroid is marked as rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fold_of, prepare
from tessera.llm.features import gram_counts, letters, unit

UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Settings:
    dim: int = 8_192
    #: About so many documents per language make its centroids.
    per_language: int = 400
    clusters: int = 4
    rounds: int = 8
    #: A text whose best cosine is lower is rejected.
    min_cosine: float = 0.1


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    langs: list[str]
    centroids: np.ndarray
    settings: Settings


def _tf(text: str, dim: int) -> np.ndarray:
    return np.log1p(gram_counts(letters(text), dim))


def _inverse_frequencies(train: DataFrame, dim: int) -> np.ndarray:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(dim + 1, np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                seen[:dim] += gram_counts(letters(t), dim) > 0
                seen[dim] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["bucket", "n"])

    made = train.select("text").mapInArrow(each, "bucket bigint, n bigint")
    total = np.zeros(dim + 1)
    for r in made.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # dim + 1 rows at most
        total[r["bucket"]] = r["n"]
    return np.log((1 + total[dim]) / (1 + total[:dim])) + 1


def cluster(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """At most ``k`` unit centroids of the unit rows of ``x`` (spherical k-means)."""
    centers = [unit(x.mean(axis=0))]
    while len(centers) < min(k, len(x)):
        centers.append(x[(x @ np.array(centers).T).max(axis=1).argmin()])
    made = np.array(centers)
    for _ in range(rounds):
        near = (x @ made.T).argmax(axis=1)
        made = np.array([unit(x[near == j].mean(axis=0)) if (near == j).any() else made[j] for j in range(len(made))])
    return made


def fit(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> Model | None:
    """Centroids from the rows of folds 1 to 4 with a language and a letter; None if there are none."""
    prepare(docs.sparkSession)
    s = settings
    train = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    train = train.where((fold_of(F.col("id")) != 0) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["count"] for r in train.groupBy("lang").count().collect()}  # one row per language
    if not counts:
        return None
    idf = _inverse_frequencies(train, s.dim)
    steps = 1 << 30
    share = F.create_map(*(F.lit(v) for lang, n in counts.items() for v in (lang, min(steps, int(steps * s.per_language / n)))))
    draw = F.xxhash64("id", F.lit("language"))
    sample = train.where(F.pmod(draw, F.lit(steps)) < share[F.col("lang")]).select("lang", draw.alias("draw"), "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [unit(_tf(t, s.dim) * idf).astype("<f4").tobytes() for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(raw, pa.binary())], names=["lang", "draw", "vector"])

    def centers(key: tuple, part: pa.Table) -> pa.Table:
        part = part.sort_by([("draw", "ascending"), ("vector", "ascending")])
        x = np.frombuffer(b"".join(part.column("vector").to_pylist()), "<f4").reshape(-1, s.dim)
        made = cluster(x.astype(np.float64), s.clusters, s.rounds)
        return pa.table({"lang": [key[0].as_py()] * len(made), "k": list(range(len(made))), "center": pa.array([c.astype("<f4").tobytes() for c in made], pa.binary())})

    made = sample.mapInArrow(vectors, "lang string, draw bigint, vector binary").groupBy("lang")
    rows = sorted(made.applyInArrow(centers, "lang string, k bigint, center binary").collect())  # clusters rows per language
    if not rows:
        return None
    return Model(idf, [r["lang"] for r in rows], np.array([np.frombuffer(r["center"], "<f4") for r in rows]), s)


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, held_out, lang_pred, score, rejected) of every row of ``docs``.

    ``score`` is the cosine with the nearest centroid, ``rejected`` whether it is
    below the model's limit (``lang_pred`` then still names the nearest).

    * Null text, a text without a letter, and no model: ``und``, score 0, rejected.
    * Equally near centroids: the first language in alphabetical order.
    * Repeated rows and null ids: each row gets its result; a null id is not held out.
    * An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)  # dim numbers per centroid
    kind = docs.schema[id_col].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            lang, score = [], []
            for t in b.column(2).to_pylist():
                if m is None or not t or not _LETTER.search(t):
                    lang.append(UNKNOWN)
                    score.append(0.0)
                    continue
                near = m.centroids @ unit(_tf(t, m.settings.dim) * m.idf)
                best = int(near.argmax())
                lang.append(m.langs[best])
                score.append(min(1.0, max(0.0, float(near[best]))))
            far = [m is None or x == UNKNOWN or v < m.settings.min_cosine for x, v in zip(lang, score)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(far, pa.bool_())],
                names=[id_col, "held_out", "lang_pred", "score", "rejected"],
            )

    rows = docs.select(F.col(id_col), F.coalesce(fold_of(F.col(id_col)) == 0, F.lit(False)).alias("held_out"), F.col(text_col))
    return rows.mapInArrow(each, f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double, rejected boolean")
