"""Quality classifier from weak labels.

Overlapping heuristics vote good, bad or nothing on each text. How often each
combination of votes occurs is counted over all documents, and expectation
maximisation on these counts estimates the heuristics' accuracies and each
combination's posterior. A hashed linear scorer is trained on the posteriors of
a bounded sample, and scores every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prepare, threshold_sample
from tessera.llm.features import fit_logistic, gram_counts, shapes, sigmoid, unit

_SIGNS = re.compile(r"[#*$%&|<>{}=\\^~]")
_SHOUT = re.compile(r"[!?]{2,}")
_END = re.compile(r"[.!?]+(?:\s|$)")
#: Signs that menus and link lists put between their entries.
SEPARATORS = ("|", "•", "·", "»", "›", "/")


@dataclass(frozen=True)
class Settings:
    dim: int = 1_024
    #: About so many documents train the scorer.
    sample: int = 8_000
    rounds: int = 50
    #: Texts scored lower are rejected.
    min_score: float = 0.5


#: What each labeller measures: good up to the first value, bad from the second on, else no vote.
CUTS = {
    "signs": (0.1, 0.3),
    "shouting": (0.05, 0.2),
    "capitals": (0.25, 0.6),
    "other characters": (0.2, 0.35),
    "word length": (3, 8),
    "sentence length": (40, 120),
    "repeated lines": (0.2, 0.5),
    "lone separators": (0.02, 0.15),
    "repeated words": (0.03, 0.15),
    "longest run": (2, 5),
    "no function words": (0.92, 0.985),
}
LABELLERS = tuple(CUTS)
#: Frequent short words of the languages that the corpus is made of.
FUNCTION_WORDS = frozenset(
    """
    the of and to in is it that for as with by on at this be are or from
    der die das und in den von zu mit sich des auf für ist im dem nicht ein eine
    le la les de des et en un une du que est pour dans par sur au qui ne
    el los las del y que se por con una para es su al lo como más o
    """.split()
)


def measures(text: str | None) -> tuple[float | None, ...]:
    """What each labeller measures on a text; None where there is too little to tell.

    A text too short for function words has none missing, so that short texts are not one side's.
    """
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return (None,) * len(CUTS)
    chars = sum(map(len, words))
    alphas = sum(map(str.isalpha, text))
    upper = sum(map(str.isupper, text))
    lines = [x for x in text.split("\n") if x.strip()]
    runs = [len(list(same)) for _, same in groupby(words)]
    known = sum(w.strip(".,;:!?").lower() in FUNCTION_WORDS for w in words)
    return (
        sum(_SIGNS.search(w) is not None for w in words) / n if _SIGNS.search(text) else 0.0,
        len(_SHOUT.findall(text)) / n,
        (upper / alphas if alphas else 1.0) if chars >= 40 else None,
        1 - alphas / chars,
        abs(chars / n - 6),
        n / max(1, len(_END.findall(text))),
        1 - len(set(lines)) / len(lines) if len(lines) > 3 else None,
        sum(map(words.count, SEPARATORS)) / n,
        1 - len(runs) / n,
        max(runs),
        1 - known / n if n >= 40 else 0.0,
    )


def votes(text: str | None, made: tuple[float | None, ...] | None = None) -> tuple[int, ...]:
    """One vote per labeller: 1 good, -1 bad, 0 nothing. No word: all bad."""
    made = made or measures(text)
    if all(m is None for m in made):
        return (-1,) * len(CUTS)
    return tuple(0 if m is None else 1 if m <= good else -1 if m >= bad else 0 for m, (good, bad) in zip(made, CUTS.values()))


def posteriors(counts: dict[tuple[int, ...], int], rounds: int = 50) -> dict[tuple[int, ...], float]:
    """Probability of good for each combination of votes, by expectation maximisation.

    The start (a majority of votes) says which of the two classes is good. The
    labellers' rates are smoothed, so one never decides alone.
    """
    if not counts:
        return {}
    seen = np.array(list(counts))
    n = np.array(list(counts.values()), float)
    p = np.clip(0.5 + seen.mean(axis=1) / 2, 0.05, 0.95)
    for _ in range(rounds):
        logs = []
        for weight in (n * p, n * (1 - p)):
            rate = np.array([[(weight * (seen[:, k] == v)).sum() for v in (-1, 0, 1)] for k in range(seen.shape[1])])
            rate = (rate + 1) / (weight.sum() + 3)
            prior = (weight.sum() + 1) / (n.sum() + 2)
            logs.append(np.log(prior) + sum(np.log(rate[k])[seen[:, k] + 1] for k in range(seen.shape[1])))
        p = sigmoid(logs[0] - logs[1])
    return dict(zip(counts, p.tolist()))


def _kinds(text: str) -> np.ndarray:
    """One byte per word: a function word, the word before again, one with signs, or any other."""
    words = text.split()
    kinds = bytearray()
    for word, before in zip(words, [None, *words]):
        if word == before:
            kinds += b"r"
        elif word.strip(".,;:!?").lower() in FUNCTION_WORDS:
            kinds += b"f"
        else:
            kinds += b"s" if _SIGNS.search(word) else b"o"
    return np.frombuffer(bytes(kinds), np.uint8)


def _vector(text: str | None, dim: int) -> np.ndarray:
    """Hashed grams of the characters' shapes, and in an eighth as many buckets those of the words' kinds."""
    text = text or ""
    parts = (gram_counts(shapes(text), dim), gram_counts(_kinds(text), dim // 8))
    return np.concatenate([unit(np.log1p(part)) for part in parts])


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    settings: Settings


def fit(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """Votes over all rows, accuracies, and a scorer of a bounded sample; None without rows.

    A row's lot is drawn from its id and text, so rows that repeat both would all
    be drawn at once: they count once in the sample. Where so many rows repeat
    that none is drawn, lots are drawn from the rows' places as well.
    """
    prepare(docs.sparkSession)
    s = settings

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([",".join(map(str, votes(t))) for t in b.column(0).to_pylist()])], names=["votes"])

    made = docs.select(text_col).mapInArrow(vote, "votes string").groupBy("votes").count()
    counts = {tuple(map(int, r["votes"].split(","))): r["count"] for r in made.collect()}  # 3 ** 7 rows at most
    if not counts:
        return None
    good = posteriors(counts, s.rounds)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            raw = [_vector(t, s.dim).astype("<f4").tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary()), pa.array([good[votes(t)] for t in texts])], names=["vector", "good"])

    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    for lot in (F.xxhash64("id", "text"), F.xxhash64("id", "text", F.monotonically_increasing_id())):
        sample = threshold_sample(keyed, lot, s.sample, sum(counts.values())).dropDuplicates(["id", "text"])
        found = sample.mapInArrow(vectors, "vector binary, good double").toArrow().sort_by([("vector", "ascending")])
        if len(found):
            break
    else:
        return None
    x = np.frombuffer(b"".join(found.column("vector").to_pylist()), "<f4").reshape(len(found), -1)
    return Model(fit_logistic(x, found.column("good").to_numpy(), ridge=0.05, steps=12), s)


def _scores(texts: list, model: Model | None) -> np.ndarray:
    if model is None:
        return np.zeros(len(texts))
    return np.array([float(sigmoid(_vector(t, model.settings.dim) @ model.weights[:-1] + model.weights[-1])) for t in texts])


def classify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score, kept) of every row of ``docs``; score 1 is good.

    * Null text counts as empty; a text without a word has score 0 and is rejected.
    * Repeated rows and null ids: each row gets its result, equal texts the same.
    * No model (fitted on an empty table): score 0. An empty table gives no rows.
    * Other columns are not read.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # dim numbers
    kind = docs.schema[id_col].dataType.simpleString()
    limit = model.settings.min_score if model else 0.5

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            score = np.where([bool(t and not t.isspace()) for t in texts], _scores(texts, shared.value), 0.0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score), pa.array(score >= limit)], names=[id_col, "score", "kept"])

    return docs.select(id_col, text_col).mapInArrow(each, f"`{id_col}` {kind}, score double, kept boolean")


def keep_good(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``classify`` rejects; the columns stay.

    * Null texts and those without a word are rejected.
    * Repeated rows and null ids: each row is judged on its own, equal texts alike.
    * Other columns may have any name and pass through. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    limit = model.settings.min_score if model else 0.5
    at = docs.columns.index(text_col)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).to_pylist()
            worded = np.array([bool(t and not t.isspace()) for t in texts], bool)
            yield b.filter(pa.array((_scores(texts, shared.value) >= limit) & worded, pa.bool_()))

    return docs.mapInArrow(each, docs.schema)
