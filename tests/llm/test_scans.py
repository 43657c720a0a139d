"""License scans, quality rules, SimHash and packing against brute force."""

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

from conftest import SF_SMALL
from tessera.llm import licenses, packing, quality, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, fp string, rank int"
ODD_TEXTS = [
    None,
    "",
    "   \n\t ",
    "one",
    "one two",
    "Released under the MIT License.",
    "under the mit license under the mit license x Apache License, Version 2.0 CC BY-NC",
    "This work is licensed under the shiny GNU General Public License, version 3.",
    "été Été ÉTÉ naïve ﬁne “quoted” don't I'LL ₂ Σίσυφος ΣΑΣ İstanbul ẛ̣ 日本語 \x1c x y 10,000",
    "the same line again and again\n" * 60,
    "word " * 30_000 + "end",
    "a|b < # ! ?? <|endoftext|> </w>",
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, ties, repeated rows, a very long text and columns with clashing names."""
    rows = [(k, t, None, None, None, "x", "y", 1) for k, t in enumerate(ODD_TEXTS)]
    rows += [rows[5], rows[5], (None, "under the mit license", "en", "s", 1, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def test_license_scan_equals_sql(spark, odd):
    got = licenses.license_scan(odd)
    documents = odd.select("doc_id", "text").toPandas()  # noqa: F841  read by DuckDB
    want = duckdb.connect().execute(licenses.oracle_sql(table="documents")).fetchall()
    key = repr
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


AGPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
    "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
)


def labels_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    got = {r["doc_id"]: r["labels"] for r in licenses.license_scan(df).collect()}
    assert got == {r[0]: r[6] for r in con.execute(licenses.oracle_sql()).fetchall()}
    return [got[k] for k in range(len(texts))]


def test_one_notice_gives_one_license(spark):
    notices = licenses.NOTICES
    texts = [f"Some words before. {text} And others after it." for _, text in notices]
    assert labels_of(spark, texts) == [label for label, _ in notices]


def test_two_notices_give_two_licenses(spark):
    pairs = [(a, b) for a in licenses.NOTICES for b in licenses.NOTICES if a[0] < b[0]]
    texts = [f"{a[1]} {b[1]}" for a, b in pairs]
    assert labels_of(spark, texts) == [",".join(sorted({a[0], b[0]})) for a, b in pairs]


def test_notices_that_differ_a_little(spark):
    gpl = next(text for label, text in licenses.NOTICES if label == "gpl-2")
    nc = "This work is made available and licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."
    texts = [AGPL, AGPL.replace("modify it", "change it"), gpl.replace("redistribute", "share"), nc, gpl.replace("version 2", "version X"), (gpl + " filler " * 300) * 40]
    assert labels_of(spark, texts) == ["agpl-3", "agpl-3", "gpl-2", "cc-by-nc", "gpl-3", "gpl-2"]


def test_license_places_by_hand(spark, odd):
    rows = {r["doc_id"]: r for r in licenses.license_scan(odd).collect()}
    r = rows[6]
    assert (r["n_base"], r["first_word"], r["last_word"], r["score"]) == (4, 0, 14, 1.0)
    assert r["base_labels"] == "apache-2,cc-by-nc,mit"
    near = rows[7]  # one word put in: no phrase, but the notice is found
    assert (near["n_base"], near["base_labels"], near["labels"]) == (0, "", "gpl-3")
    assert 0.8 <= near["score"] <= 1


def brute_quality(text):
    words = (text or "").encode().split()
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = [windows[w] > 1 for w in zip(words, words[1:], words[2:])]
    inside = sum(any(repeated[max(0, k - 2) : k + 1]) for k in range(len(words)))
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    base = (
        len(words),
        sum(len(w.decode()) for w in words),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        inside,
    )
    return (*base, len(words) < 50 or 100 * inside > 50 * len(words))


def test_quality_counts(spark, odd):
    got = quality.quality_rules(odd)
    for r in got.collect():
        text = "under the mit license" if r["doc_id"] is None else ODD_TEXTS[r["doc_id"]]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute_quality(text)
        assert not (r["base_failed"] and r["kept"])
    assert got.count() == odd.count()


def test_quality_lines(spark):
    good = " ".join(f"w{k} goes on" for k in range(40)) + "."
    bar = " | ".join(f"Item{k}" for k in range(20))
    shout = " ".join(f"BUY{k}!!" for k in range(60))
    sign = " ".join(f"w{k}###" for k in range(400))
    docs = spark.createDataFrame(
        [(1, good), (2, f"{good}\n{bar}\nWe use cookies to help."), (3, f"{good}\n{sign}"), (4, shout)], "doc_id long, text string"
    )
    got = {r["doc_id"]: r for r in quality.quality_rules(docs).collect()}
    assert [got[k]["kept"] for k in (1, 2, 3, 4)] == [True, True, False, False]
    assert got[1]["cleaned"] == got[2]["cleaned"] == good
    kept = quality.keep_clean(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {1, 2}


def brute_fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    fps = [(k, int(f, 16) if isinstance(f, str) else f) for k, f in fps]
    root = {k: k for k, _ in fps}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, (a, x) in enumerate(fps):
        for b, y in fps[:i]:
            if (x ^ y).bit_count() <= 3 and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {k: find(k) for k, _ in fps}


def test_simhash_on_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    got = simhash.near_duplicates(docs).collect()
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in got} == {k: brute_fingerprint(t) for k, t in texts.items()}
    assert {r["doc_id"]: r["component_id"] for r in got} == brute_components([(r["doc_id"], r["fingerprint"]) for r in got])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted({r["component_id"] for r in got})


def test_simhash_odd_rows(spark, odd):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by = {r["doc_id"]: r for r in got}
    assert [by[k]["fingerprint"] for k in (0, 1, 2)] == ["0" * 16] * 3 and by[2]["component_id"] == 0
    assert by[3]["fingerprint"] == f"{brute_fingerprint('one'):016x}"
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
    lonely = odd.where("doc_id is null")
    assert simhash.keep_one(lonely.union(lonely)).count() == 1


def test_keep_one_of_each_component_under_a_shared_id(spark):
    fish, bird = "a quiet green fish swims under the old stone bridge every day", "seven loud birds argue about bread crumbs near our kitchen window"
    rows = [(1, fish, "a"), (1, bird, "b"), (1, bird, "b"), (2, fish, "c"), (3, bird, "d"), (4, "one more text that stands alone in this table", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert sorted(tuple(r) for r in simhash.keep_one(docs).collect()) == [(1, fish, "a"), (1, bird, "b"), rows[-1]]


@pytest.mark.parametrize("shape", ["one centre", "equal low halves", "equal high halves"])
def test_search_of_a_shard_that_one_tree_cannot_split(monkeypatch, shape):
    """Components of a dense shard, or of equal halves, as all pairs give them; no more links than fingerprints."""
    rng, centre = random.Random(7), 0x0123456789ABCDEF
    fps = set()
    while len(fps) < 700:
        if shape == "one centre":
            x = centre
            for b in rng.sample(range(64), rng.randint(1, 6)):
                x ^= 1 << b
        else:
            x = rng.getrandbits(14) << (rng.choice((0, 9, 18)) + (32 if shape == "equal low halves" else 0))
        fps.add(x)
    fp = np.array(sorted(fps), np.uint64).view(np.int64)
    monkeypatch.setattr(simhash, "LEAF", 16)
    home = np.array([rng.random() < 0.8 for _ in fp])
    near = np.bitwise_count(fp.view(np.uint64)[:, None] ^ fp.view(np.uint64)[None, :]) <= 3
    near &= home[:, None] | home[None, :]

    def components(pairs):
        root = list(range(len(fp)))
        for a, b in pairs:
            while root[a] != a:
                a = root[a]
            while root[b] != b:
                b = root[b]
            root[max(a, b)] = min(a, b)
        for k in range(len(fp)):
            root[k] = root[root[k]]
        return root

    found = [simhash.search(fp, home, half, 3) for half in (0, 1)]
    assert all(len(f) < len(fp) and all(near[a, b] for a, b in f) for f in found)
    assert components(found[0] + found[1]) == components(np.argwhere(near).tolist())


def test_vantage_point_trees_find_every_link(spark, monkeypatch):
    """Small shards and leaves, chains and dense groups: same components as all pairs."""
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(300)]
    for _ in range(500):  # near copies of near copies
        x = rng.choice(fps[-260:])
        for b in rng.sample(range(64), rng.randint(1, 3)):
            x ^= 1 << b
        fps.append(x)
    centre = rng.getrandbits(64)
    fps += [centre ^ (1 << b) for b in range(64)]
    fps = sorted(set(fps))
    monkeypatch.setattr(simhash, "LEAF", 8)
    made = np.array(fps, np.uint64).view(np.int64)
    for reach_half in (0, 1):
        nodes = simhash.build_tree(simhash._half(made[::3].copy(), reach_half), 3.0, shard=32)
        assert sum(n[0] is None for n in nodes) > 8
    found = set()
    for half in (0, 1):
        nodes = simhash.build_tree(simhash._half(made[::3].copy(), half), 3.0, shard=32)
        homes = 0
        for _, at, home in simhash.route(nodes, simhash._half(made, half), 1):
            homes += home.sum()
            found |= {(int(at[i]), int(at[j])) for i, j in simhash.search(made[at], home, half, 3)}
        assert homes == len(made)
    assert all((fps[i] ^ fps[j]).bit_count() <= 3 for i, j in found)
    root = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i, j in found:
            least = min(root[i], root[j])
            changed |= root[i] != least or root[j] != least
            root[i] = root[j] = least
    want = brute_components(list(enumerate(fps)))
    groups = lambda labels: sorted(sorted(k for k, v in labels.items() if v == r) for r in set(labels.values()))
    assert groups(dict(enumerate(root))) == groups(want)


def whole_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.vocabulary_path())
    return [[*e.ids, 1] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def assert_packed(rows, ids, capacity):
    places = {}
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + capacity]
        assert r["length"] == len(part) and r["start"] == r["piece"] * capacity
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in places.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places)


def test_packing_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    ids = dict(zip(texts, whole_ids(texts.values())))
    for capacity in (64, 4096):
        rows = packing.pack(docs, packing.vocabulary_path(), capacity).collect()
        assert len(rows) == sum(-(-len(x) // capacity) for x in ids.values())
        used = assert_packed(rows, ids, capacity)
        assert used <= 1.02 * -(-sum(map(len, ids.values())) // capacity) + 1


def test_packing_odd_rows(spark, odd, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 2)
    ids = dict(enumerate(whole_ids(ODD_TEXTS)))
    ids[None] = whole_ids(["under the mit license"])[0]
    rows = packing.pack(odd, packing.vocabulary_path(), 32).collect()
    assert_packed(rows, ids, 32)
    assert len(rows) == sum(-(-len(ids[r["doc_id"]]) // 32) for r in odd.collect())
    assert packing.pack(odd.limit(0), packing.vocabulary_path()).count() == 0


def test_encoder_forgets_and_still_agrees(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 5)
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["don't", "it's", "İx", "a1b22", "''s", "x_y", "…and", "naïve", "&&&", "É.", "they'LL"]) for _ in range(40)) for _ in range(30)]
    encode = packing.Encoder(packing.vocabulary_path())
    for k in range(0, 30, 7):
        some = texts[k : k + 7]
        want = [np.array(x[:-1], "<u4").tobytes() for x in whole_ids(some)]
        assert encode(some) == want


def test_plan_uses_every_piece_and_fills_gaps():
    rng = random.Random(3)
    counts = Counter(rng.randint(1, 100) for _ in range(5000))
    made = packing.plan(dict(counts), 100)
    used = Counter()
    for n, parts in made:
        assert n > 0 and sum(parts) <= 100
        for x in parts:
            used[x] += n
    assert used == counts
    assert sum(n for n, _ in made) <= 1.005 * sum(k * n for k, n in counts.items()) / 100 + 1
    assert packing.plan({}) == [] and packing.plan({4096: 3}) == [(3, [4096])]
