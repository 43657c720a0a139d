"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols (insult, threat verb, intent, target, object, article, negation,
waste, chore, wish, fate, hell, report, end of clause). The words of the symbols are given; further insults are learned as
beginnings of words, and words of intent and objects from those around threat verbs, from
one half of a bounded sample of the labelled rows. Seven small transducers rewrite and weigh
the symbols: idioms become insults, hits or plain words, threats become hits after a word of intent or before an object, insults are
hits, a target near a hit adds weight, negation and reported speech take weight away. Their composition is one
table, run over the clauses that can match. A text's features are the weights of
its matched clauses; their calibration is learned from the sample's other half.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fold_of, materialize, prepare, threshold_sample
from tessera.llm.features import fit_logistic, sigmoid

#: Words of each symbol. Fixed values.
LEXICON = {
    "insult": "idiot idiots moron morons imbecile stupid dumb fool loser losers clown clowns scum scumbag vermin filth worthless pathetic disgusting ugly bastard jerk creep retard pig coward fuck fucker shit shithead bitch asshole cunt whore slut "
    "crétin imbécile débile salaud abruti stupide dégoûtant pathétique "
    "dummkopf trottel abschaum arschloch schwachkopf widerlich erbärmlich wertlos "
    "idiota imbécil estúpido escoria asqueroso patético inútil",
    "threat": "kill hurt destroy murder stab shoot beat burn hang attack tuer frapper détruire töten umbringen schlagen matar golpear destruir",
    "intent": "will shall gonna must should ll d would going want wants wanna veux vais werde werden voy quiero",
    "target": "your they he she these those tu du ihr",
    "object": "you u them him her yourself yourselves himself herself themselves vous toi dich euch sie usted ustedes",
    "article": "the a an this that",
    "negation": "not no never isn't aren't wasn't don't dont cannot nobody pas jamais nicht kein keine nie nunca",
    "waste": "trash garbage rubbish ordure basura",
    "chore": "take takes took taken taking throw threw thrown empty emptied collect collects collected",
    "wish": "hope hopes wish wishes go",
    "fate": "die dead suffer",
    "hell": "hell",
    "report": "said says say told called wrote claimed quoted reported dit sagte dijo",
}
SYMBOLS = ("word", *LEXICON, "hit", "end")
SYMBOL_OF = {w: s for s, words in LEXICON.items() for w in words.split()}
_CLAUSE = re.compile(r"[.!?;:\n]+")
#: Contractions are cut at the apostrophe, but for those with not.
_WORD = re.compile(r"[^\W\d_]+(?:(?<=n)'t(?![^\W\d_]))?")
_MARK = re.compile(r"[\"“”„«»]")
#: Words before and behind a threat verb that can be learned as intent and object.
BEFORE, BEHIND = 3, 1


@dataclass(frozen=True)
class Transducer:
    """(state, symbol) -> (next state, symbol written, weight); state 0 starts."""

    arcs: dict[tuple[int, str], tuple[int, str, float]]

    def run(self, symbols: list[str]) -> list[float]:
        """Weights of the hits written for one clause; a weight is not below zero."""
        state, found = 0, []
        for s in symbols:
            state, out, weight = self.arcs[state, s]
            if out == "hit":
                found.append(max(0.0, weight))
        return found


def machine(states: int, arc) -> Transducer:
    return Transducer({(q, s): arc(q, s) for q in range(states) for s in SYMBOLS})


def compose(a: Transducer, b: Transducer) -> Transducer:
    """What ``a`` writes is read by ``b``; weights add up."""
    number, todo, arcs = {(0, 0): 0}, [(0, 0)], {}
    while todo:
        p, q = todo.pop()
        for s in SYMBOLS:
            p2, mid, wa = a.arcs[p, s]
            q2, out, wb = b.arcs[q, mid]
            if (p2, q2) not in number:
                number[p2, q2] = len(number)
                todo.append((p2, q2))
            arcs[number[p, q], s] = (number[p2, q2], out, wa + wb)
    return Transducer(arcs)


def _threat(q: int, s: str):
    """A threat verb within three words of a word of intent is a hit."""
    if s == "intent":
        return 3, s, 0.0
    if s == "threat":
        return 0, "hit" if q else s, 1.5 if q else 0.0
    return (0 if s == "end" else max(0, q - 1)), s, 0.0


def _aimed(q: int, s: str):
    """An object right behind a threat verb is a hit; behind an article the verb is a noun."""
    if s == "threat":
        return (0, "word", 0.0) if q == 2 else (1, s, 0.0)
    if s == "object" and q == 1:
        return 0, "hit", 1.5
    return (2 if s == "article" else 0), s, 0.0


def _idiom(q: int, s: str):
    """Waste is an insult, but not within three words after a chore; an ill fate wished upon someone, or hell, is a hit.

    States 1 to 3 count the words down after a wish, 4 to 6 after one that has met
    a target or an object, 7 to 9 after a chore.
    """
    if s == "wish":
        return 3, "word", 0.0
    if s == "chore":
        return 9, "word", 0.0
    if s == "waste":
        return 0, ("word" if q > 6 else "insult"), 0.0
    if s == "hell" and 0 < q < 7 or s == "fate" and 3 < q < 7:
        return 0, "hit", 1.5
    if s in ("target", "object"):
        return (q + 2 if 1 < q < 4 else max(4, q - 1) if 3 < q < 7 else 0), s, 0.0
    left = 0 if s == "end" or q in (1, 4, 7) else max(0, q - 1)
    return left, ("word" if s in ("fate", "hell") else s), 0.0


def _insult(q: int, s: str):
    return 0, ("hit" if s == "insult" else s), (1.0 if s == "insult" else 0.0)


def _target(q: int, s: str):
    """A hit within four words after a target weighs more."""
    if s in ("target", "object"):
        return 4, s, 0.0
    return (0 if s == "end" else max(0, q - 1)), s, (0.5 if s == "hit" and q else 0.0)


def _negation(q: int, s: str):
    """A hit within two words after a negation weighs less; intent and threat verbs between do not count."""
    if s == "negation":
        return 2, s, 0.0
    if s in ("intent", "threat"):
        return q, s, 0.0
    return (0 if s == "end" else max(0, q - 1)), s, (-0.9 if s == "hit" and q else 0.0)


def _report(q: int, s: str):
    """A hit in a clause behind a word of reporting weighs less."""
    if s in ("report", "end"):
        return int(s == "report"), s, 0.0
    return q, s, (-0.6 if s == "hit" and q else 0.0)


GRAMMAR = reduce(compose, [machine(10, _idiom), machine(4, _threat), machine(3, _aimed), machine(1, _insult), machine(5, _target), machine(3, _negation), machine(2, _report)])


#: Lengths of learned beginnings; a whole word is written with a blank behind it.
STEMS = range(4, 9)


def stems_of(word: str) -> list[str]:
    """Beginnings of a word that can be learned, and the whole word."""
    return [*(word[:k] for k in STEMS if k < len(word)), word + " "]


def _symbols(words: set[str], learned: frozenset[str]) -> dict[str, str]:
    """The symbols of those words that have one."""
    found = {w: SYMBOL_OF[w] for w in words & SYMBOL_OF.keys()}
    found.update((w, "negation") for w in words - found.keys() if w.endswith("n't"))
    if learned:
        found.update((w, "insult") for w in words - found.keys() if not learned.isdisjoint(stems_of(w)))
        found.update((w, "intent") for w in words - found.keys() if "<" + w in learned)
        found.update((w, "object") for w in words - found.keys() if ">" + w in learned)
    return found


def _lower(text: str | None) -> str:
    return (text or "").lower().replace("’", "'")


def contexts_of(low: str) -> set[str]:
    """The words around threat verbs: "<" and a word before, ">" and a word behind."""
    found: set[str] = set()
    for clause in _CLAUSE.split(low):
        words = _WORD.findall(clause)
        for k, w in enumerate(words):
            if SYMBOL_OF.get(w) == "threat":
                found.update("<" + x for x in words[max(0, k - BEFORE) : k] if x not in SYMBOL_OF)
                found.update(">" + x for x in words[k + 1 : k + 1 + BEHIND] if x not in SYMBOL_OF)
    return found


def features(text: str | None, learned: frozenset[str] = frozenset()) -> tuple[float, float, float]:
    """(log of the summed weight, largest weight, log of the matched clauses)."""
    low = _lower(text)
    symbols = _symbols(set(_WORD.findall(low)), learned)
    hits = {w for w, s in symbols.items() if s in ("insult", "threat", "waste", "fate", "hell")}
    if not hits:
        return 0.0, 0.0, 0.0
    total, top, clauses = 0.0, 0.0, 0
    at, reported, quoted = 0, False, False  # reported: speech from an earlier clause goes on
    for cut in _CLAUSE.finditer(low + "\n"):
        clause, at = low[at : cut.start()], cut.end()
        if quoted and _MARK.match(clause):
            clause, reported, quoted = clause[1:], False, False
        words = _WORD.findall(clause)
        if not hits.isdisjoint(words):
            found = GRAMMAR.run(["report"] * reported + [symbols.get(w, "word") for w in words])
            if any(found):
                total, top, clauses = total + sum(found), max(top, *found), clauses + 1
        reported = reported or any(symbols.get(w) == "report" for w in words)
        quoted = reported and quoted ^ (len(_MARK.findall(clause)) % 2 == 1)
        # over a colon, and in open quotation marks to the end of the line
        reported = reported and (set(cut[0]) <= {":", "\n"} and ":" in cut[0] or quoted and "\n" not in cut[0])
        quoted = quoted and reported
    return float(np.log1p(total)), top, float(np.log1p(clauses))


@dataclass(frozen=True)
class Settings:
    #: About so many labelled rows are learned from.
    sample: int = 20_000
    #: A learned beginning stands in so many toxic texts at least ...
    min_toxic: int = 6
    #: ... and in at most so many others for each of them.
    max_clean: float = 0.02
    #: Bounds the model: of more beginnings that qualify, those in the most toxic texts are kept. What qualifies comes
    #: from the labelled sample alone, so the bound does not depend on the size of the corpus that is scored.
    max_learned: int = 2_000
    #: Calibration without any labelled row of either kind.
    default: tuple[float, ...] = (1.0, 2.0, 0.5, -2.0)


def learn_insults(rows: DataFrame, settings: Settings) -> frozenset[str]:
    """Beginnings of words, and words around threat verbs, that hardly any but toxic texts (text, y) hold.

    Equal texts count once. Of a beginning and a longer one, the shorter stays.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                low = _lower(text)
                words = set(_WORD.findall(low))
                found = {p for w in words if w not in SYMBOL_OF for p in stems_of(w)}
                if any(SYMBOL_OF.get(w) == "threat" for w in words):
                    found |= contexts_of(low)
                found = sorted(found)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([y] * len(found), pa.float64())], names=["stem", "y"])

    distinct = rows.groupBy("text").agg(F.max("y").alias("y"))
    made = distinct.mapInArrow(each, "stem string, y double").groupBy("stem").agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("clean"))
    good = (F.col("toxic") >= settings.min_toxic) & (F.col("clean") <= settings.max_clean * F.col("toxic"))
    top = made.where(good).orderBy(F.desc("toxic"), "stem").limit(settings.max_learned).collect()
    kept: set[str] = set()
    for stem in sorted((r["stem"] for r in top), key=lambda x: (len(x), x)):
        if stem[0] in "<>" or not any(stem[:k] in kept for k in STEMS if k < len(stem)):
            kept.add(stem)
    return frozenset(kept)


def score(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> DataFrame:
    """(id_col, held_out, score, predicted, matched) of every row of ``docs``.

    ``matched`` is the log of one plus the weight of all matched clauses. Labels
    of fold 0 are never read.

    * Null or empty text: no clause matches; it has the score of such texts.
    * Repeated rows: each gets the same result. Of several labels of an id the
      largest counts; null labels and null ids teach nothing.
    * Labels of one kind only, or none: the default calibration.
    * An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    kind = docs.schema[id_col].dataType.simpleString()

    known = labels.select(F.col(id_col).alias("known"), F.col(label_col).alias("y")).where("y is not null")
    known = known.where(fold_of(F.col("known")) != 0).groupBy("known").agg((F.max("y") > 0).cast("double").alias("y"))
    known = materialize(threshold_sample(known, F.col("known"), settings.sample, known.count()))
    # about settings.sample ids: small enough to be sent to the texts
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), F.col("id") == F.col("known"))
    first_half = F.pmod(F.xxhash64("id", F.lit("half")), F.lit(2)) == 0
    learned = learn_insults(sample.where(first_half).select("text", "y"), settings)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t, learned) for t in b.column(1).to_pylist()]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x[:, k]) for k in range(3))], names=["id", "x0", "x1", "x2"])

    made = docs.select(id_col, text_col).mapInArrow(measure, f"id {kind}, x0 double, x1 double, x2 double")
    made = materialize(made.withColumn("fold", fold_of(F.col("id"))))
    # of repeated ids one row is learned from
    train = made.join(F.broadcast(known), F.col("id") == F.col("known")).where(~first_half)
    train = train.groupBy("id").agg(*(F.max(c).alias(c) for c in ("x0", "x1", "x2", "y")))
    found = train.sort("id").toArrow()
    x = np.column_stack([found.column(c).to_numpy() for c in ("x0", "x1", "x2")])
    y = found.column("y").to_numpy()
    weights = fit_logistic(x, y) if 0 < y.sum() < len(y) else np.array(settings.default)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.column_stack([b.column(k).to_numpy() for k in (2, 3, 4)])
            p = sigmoid(x @ weights[:-1] + weights[-1])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), b.column(2)],
                names=[id_col, "held_out", "score", "predicted", "matched"],
            )

    rows = made.select("id", F.coalesce(F.col("fold") == 0, F.lit(False)).alias("held_out"), "x0", "x1", "x2")
    return rows.mapInArrow(rate, f"`{id_col}` {kind}, held_out boolean, score double, predicted int, matched double")
