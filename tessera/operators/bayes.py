"""Multinomial naive Bayes over word counts (ML1-ML3, ML5): a text classifier
in closed form.

Fitting is two aggregates: words per (class, word) and documents per class.
With ``n`` occurrences of a word in a class, ``N`` words in the class and ``V``
different words in all, a word weighs ``log((n + a) / (N + a V))``. Scoring
joins the words of a document with the word table; a document's words are
counted first, so a word is shuffled once per document. Words that no training
document has are left out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize


def _words(df: DataFrame, cols: list, text: str) -> DataFrame:
    """(cols, word, n): how often each word stands in a text, counted in its row."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), " "), lambda w: w != "")
    counted = df.select(*cols, F.explode(words).alias("word"))
    return counted.groupBy(*[F.col(c) for c in counted.columns]).agg(F.count(F.lit(1)).alias("n"))


@dataclass
class NaiveBayes:
    """``classes``: (label, log prior, weight of a known word that the class never has), in label order, one for each
    label; ``words``: (word, entries), ``entries`` being what the classes that have the word add to that weight."""

    classes: list[tuple[str, float, float]]
    words: DataFrame

    @property
    def labels(self) -> list[str]:
        return [c[0] for c in self.classes]

    def scores(self, df: DataFrame, key: str, text: str, keep: list[str] | None = None) -> DataFrame:
        """``(key, input_text, keep..., score)``: log joint probabilities in label order. ``key`` tells documents
        apart; a text without a known word has the priors."""
        found = _words(df, [key], text).join(self.words, "word").withColumn("__w", F.map_from_entries("entries"))
        sums = found.groupBy(key).agg(
            F.sum("n").alias("__known"),
            *[F.sum(F.col("n") * F.col("__w")[label]).alias(f"__sum{i}") for i, (label, _, _) in enumerate(self.classes)],
        )
        both = df.select(key, F.col(text).alias("input_text"), *(keep or [])).join(sums, key, "left")
        raw = [
            F.lit(prior) + F.coalesce(F.col("__known"), F.lit(0)) * F.lit(missing) + F.coalesce(F.col(f"__sum{i}"), F.lit(0.0))
            for i, (_, prior, missing) in enumerate(self.classes)
        ]
        return both.withColumn("score", F.array(*raw)).drop("__known", *[f"__sum{i}" for i in range(len(self.classes))])

    def probabilities(self, df: DataFrame, key: str, text: str) -> DataFrame:
        """``(key, input_text, probability)``, probabilities in label order."""
        held = self.scores(df, key, text).withColumn("__exp", F.transform("score", lambda x: F.exp(x - F.array_max("score"))))
        total = F.aggregate("__exp", F.lit(0.0), lambda a, x: a + x)
        return held.select(key, "input_text", F.transform("__exp", lambda x: x / total).alias("probability"))

    def log_loss(self, df: DataFrame, key: str, text: str, label: str) -> DataFrame:
        """ML1: ``(loss, n)``, the mean negative log probability of the true label; rows with an unknown label are
        left out. Taken from the scores, so a hopeless text has a large loss and not an infinite one."""
        held = self.scores(df, key, text, [label])
        top = F.array_max("score")
        total = F.log(F.aggregate("score", F.lit(0.0), lambda a, x: a + F.exp(x - top)))
        at = F.array_position(F.array(*[F.lit(c) for c in self.labels]), F.col(label))
        loss = F.when(at > 0, total + top - F.get("score", (at - 1).cast("int")))
        return held.agg(F.avg(loss).alias("loss"), F.count(loss).alias("n"))


def fit_naive_bayes(train: DataFrame, *, label: str = "tag", text: str = "text", alpha: float = 1.0) -> NaiveBayes:
    """ML1: fit on ``train``; rows with a NULL label are left out. The class table is bounded by the label set."""
    rows = train.where(F.col(label).isNotNull())
    words = materialize(_words(rows, [F.col(label).alias("label")], text))  # read by each of the sums below
    per_word = words.groupBy("word").agg(F.collect_list(F.struct("label", F.log((F.col("n") + alpha) / F.lit(alpha)).alias("weight"))).alias("entries"))
    docs = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    held = {r["label"]: r["n"] for r in words.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    size = words.select("word").distinct().count()
    total = sum(docs.values())
    classes = [
        (c, math.log(docs[c] / total), math.log(alpha / (held.get(c, 0) + alpha * size)) if size else 0.0) for c in sorted(docs)
    ]
    return NaiveBayes(classes, per_word)
