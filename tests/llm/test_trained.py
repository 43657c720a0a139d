"""Language identification and the weak-label model against plain Python on every row."""

import math
import random
import zlib
from collections import Counter

import pytest

from conftest import SF_SMALL
from tessera.llm import classifier, language


def grams(text, dim):
    """Hashed byte 1- to 3-grams of the lower-cased text, runs of ASCII characters other than letters as one blank."""
    data = [" "]
    for b in text.lower().encode():
        c = chr(b) if b >= 128 or chr(b).islower() else " "
        if c != " " or data[-1] != " ":
            data.append(c)
    if data[-1] != " ":
        data.append(" ")
    out = Counter()
    for size in (1, 2, 3):
        for k in range(len(data) - size + 1):
            key = size
            for c in data[k : k + size]:
                key = (key * 257 + ord(c)) % 2**64
            out[((key * 0x9E3779B97F4A7C15 % 2**64) >> 40) % dim] += 1
    return out


def cosine(text, centroid, idf, dim):
    v = {g: math.log1p(n) * idf[g] for g, n in grams(text, dim).items()}
    length = math.sqrt(sum(x * x for x in v.values()))
    return sum(x * float(centroid[g]) for g, x in v.items()) / length


def test_language_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = docs.collect()
    model = language.fit(docs)
    dim = model.settings.dim
    train = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 and r.lang is not None and any(c.isalpha() for c in r.text or "")]
    seen = Counter(g for r in train for g in grams(r.text, dim))
    idf = [math.log((1 + len(train)) / (1 + seen[g])) + 1 for g in range(dim)]
    assert idf == pytest.approx(model.idf.tolist())
    got = {r.doc_id: r for r in language.identify(docs, model).collect()}
    for r in random.Random(1).sample(rows, 60):
        near = [cosine(r.text, c, idf, dim) for c in model.centroids]
        assert got[r.doc_id].score == pytest.approx(max(near), abs=1e-6)
        assert got[r.doc_id].lang_pred in {model.langs[k] for k, v in enumerate(near) if v > max(near) - 1e-6}
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_texts_far_from_every_language_are_rejected(spark):
    model = language.fit(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    texts = ["жжжжжжжжжжжжжжжжжжжжжжжжжжжжжж", "漢漢漢漢漢漢漢漢漢漢漢漢漢漢漢", "this and that of the other"]
    got = language.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    assert [r.rejected for r in sorted(got)] == [True, True, False]


def em(documents, rounds):
    """Expectation maximisation over single documents: the posterior of good of each."""
    k = len(documents[0])
    p = [min(0.95, max(0.05, 0.5 + sum(v) / k / 2)) for v in documents]
    for _ in range(rounds):
        logs = []
        for weight in (p, [1 - x for x in p]):
            total = sum(weight)
            rate = [{v: (sum(w for w, d in zip(weight, documents) if d[j] == v) + 1) / (total + 3) for v in (-1, 0, 1)} for j in range(k)]
            prior = (total + 1) / (len(documents) + 2)
            logs.append([math.log(prior) + sum(math.log(rate[j][d[j]]) for j in range(k)) for d in documents])
        p = [1 / (1 + math.exp(-max(-30, min(30, a - b)))) for a, b in zip(*logs)]
    return p


def test_posteriors_equal_brute_force():
    rng = random.Random(2)
    documents = []
    for _ in range(400):
        good = rng.random() < 0.8
        documents.append(tuple(rng.choices((1, 0, -1), (7, 2, 1) if good else (2, 2, 6))[0] for _ in range(5)))
    made = classifier.posteriors(Counter(documents), rounds=12)
    assert [made[d] for d in documents] == pytest.approx(em(documents, 12), abs=1e-9)


def test_posteriors_of_all_documents(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    documents = [classifier.votes(t) for t in texts]
    made = classifier.posteriors(Counter(documents), rounds=10)
    assert [made[d] for d in documents] == pytest.approx(em(documents, 10), abs=1e-9)
