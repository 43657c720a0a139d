"""Token counts, conversation repair and lexical search against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from conftest import SF_SMALL
from tessera.llm import conversations, lexical, queries, tokencount

ALPHABET = [
    "a", "b", "th", "e", " ", "  ", "\n", "\t", "'s", "'re", "'", "'l", "l", "1", "23", "!", "...", "é", "ß", "中", "文", "字",
    " ", "　", "🙂", "İ", "<|endoftext|>", "<|", "ing", "tion", "A", "ᲊ", "՘", "₏", "٣", "\u0085",
]
LONG_TEXTS = ["a" * 5000, "ab" * 3000, " " * 6000, "\n " * 3000, "x" + " " * 5000 + "y", "中文" * 2000, "-=" * 2500, "7" * 4097, "word " * 40_000]


@pytest.fixture(scope="module")
def counter():
    return tokencount.counter(tokencount.vocabulary_path())


def library_counts(texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokencount.vocabulary_path())
    return [len(e.ids) for e in whole.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_counter_equals_library(counter):
    rng = random.Random(5)
    texts = ["", "'re 's ''s x''ll", "a <|endoftext|> b  \n", "   <|endoftext|>   x", "<|endoftext|><|endoftext|>", "\n\n\nx"]
    texts += ["".join(rng.choices(ALPHABET, k=rng.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randint(0, 0x24F), rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(30)) for _ in range(500)]
    texts += LONG_TEXTS + ["".join(rng.choices("aab", k=20_000))]
    assert counter([t.encode() for t in texts]).tolist() == library_counts(texts)


def test_counter_forgets_states_without_effect(counter, monkeypatch):
    monkeypatch.setattr(tokencount, "MOST_STATES", 10)
    monkeypatch.setattr(tokencount, "STEP_BYTES", 500)
    texts = ["".join(random.Random(k).choices(ALPHABET, k=200)) for k in range(40)]
    assert counter([t.encode() for t in texts]).tolist() == library_counts(texts)


def test_long_part_maps_meet_where_guesses_fail(counter):
    rng = random.Random(9)
    for text in ("a" * 9001, "".join(rng.choices("ab", k=5000)), "ha" * 4000):
        assert counter.merger.long_part(np.frombuffer(text.encode(), np.uint8)) == len(counter.merger.encode(text.encode()[:3000])) or len(text) > 3000
        assert counter([text.encode()]).tolist() == library_counts([text])


def test_token_counts_edges(spark):
    rows = [(k, t, 1, True) for k, t in enumerate([None, "", " \n", "a", *LONG_TEXTS])] + [(3, "a", 2, False), (None, "b c", 3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, over_limit boolean")
    got = sorted((r[0] is None, r[0] or 0, *r[1:]) for r in tokencount.token_counts(df, tokencount.vocabulary_path()).collect())
    counts = library_counts([r[1] for r in rows])
    want = sorted((r[0] is None, r[0] or 0, len((r[1] or "").encode()), n, n > 512) for r, n in zip(rows, counts))
    assert got == want
    assert tokencount.token_counts(df.where("false"), tokencount.vocabulary_path()).collect() == []


def test_op11_equals_library_on_all_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = queries.op11_token_counts(spark, SF_SMALL).collect()
    assert {r.doc_id: r.n_tokens for r in got} == dict(zip(docs, library_counts(docs.values())))
    assert len(got) == len(docs) and all(r.over_limit == (r.n_tokens > 512) and r.n_bytes == len(docs[r.doc_id].encode()) for r in got)


# --- conversations -----------------------------------------------------------------------------------------------

BLANKS = set(" \t\n\x0b\x0c\r")
AFTER = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def brute_damage(rows):
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if kind:
            x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
            yield from [(c, t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)


def grown(state, way):
    """The ways with up to three inserts after ``way``."""
    out = [(state, way)]
    for _ in range(3):
        state, (cost, audit, lines) = AFTER[out[-1][0]], out[-1][1]
        out.append((state, (cost + 2, audit + "I", [*lines, NAMES[state] + ":"])))
    return out


def brute_edits(conv):
    best = {"": (0, "", [])}
    for role, text, forced, cut in conv:
        new = {}
        for before, way in best.items():
            for state, (cost, audit, lines) in grown(before, way):
                ways = [(state, (cost + 3, audit + "D", lines))]
                if not forced:
                    to, initial = AFTER[state], role[:1]
                    ways.append((to, (cost + 2 + cut, audit + "R", [*lines, f"{NAMES[to]}:{text}"])))
                    if (initial == "s" and state == "") or (initial and initial == AFTER[state]):
                        ways.append((initial, (cost + cut, audit + "K", [*lines, f"{role}:{text}"])))
                for to, made in ways:
                    if to not in new or made[:2] < new[to][:2]:
                        new[to] = made
        best = new
    return min((w for s, way in best.items() for to, w in grown(s, way) if to in ("", "a")), key=lambda w: w[:2])


def brute_repair(rows, damaged):
    kept = brute_damage(rows) if damaged else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    by = defaultdict(list)
    for c, t, r, x in kept:
        by[c].append((t is not None, t or 0, r, x))
    out = {}
    for c in {r[0] for r in rows}:
        seen, conv, faults, turns = set(), [], defaultdict(int), [k[1] for k in by[c] if k[0]]
        for _, _, role, text in sorted(by[c]):
            ink = [ch for ch in text if ch not in BLANKS]
            fault = "blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            conv.append((role, text, fault in ("blank", "duplicate"), int(fault == "truncated")))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(conv, conv[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, lines = brute_edits(conv)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[c] = (c, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest)
    return out


SCHEMA = "conv_id long, turn long, role string, text string, state int, part int, copies string"
TEXTS = ["a.", "b", "c!", "", " \t", None, "d? ", "e. \n", "long text without end"]
ROLES = ["user", "assistant", "system", None, "", "tool", "u", "sys"]


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(3)
    return [
        (c, rng.choice([None, *range(8)]), rng.choice(ROLES), rng.choice(TEXTS), 1, 2, "x")
        for c in [*range(120), None]
        for _ in range(rng.randint(1, 9))
    ]


@pytest.mark.parametrize("damaged", [True, False])
def test_repair_equals_brute_force(spark, talks, damaged):
    df = spark.createDataFrame(talks, SCHEMA)
    got = (conversations.repair_damaged if damaged else conversations.repair)(df).collect()
    assert {r[0]: tuple(r) for r in got} == brute_repair([r[:4] for r in talks], damaged)
    assert len(got) == 121


def test_repair_of_long_conversations_in_chunks(spark, monkeypatch):
    """A conversation with nearly all rows, long runs of equal rows, and chunks that close after a few rows."""
    monkeypatch.setattr(conversations, "CHUNK_ROWS", 7)
    rng = random.Random(4)
    rows = [(1, rng.choice([None, *range(300)]), rng.choice(ROLES), f"{rng.randint(0, 200)}{rng.choice(['', '.'])}") for _ in range(900)]
    rows += [(1, 5, "user", "same.")] * 60 + [(2, None, "assistant", "q")] * 40 + [(3, 1, "user", "x" * 300_000 + ".")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    assert {r[0]: tuple(r) for r in conversations.repair(df).collect()} == brute_repair(rows, False)


def test_repair_of_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.repair_damaged(empty).collect() == []
    gone = spark.createDataFrame([(c, 0, "user", "x.") for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0], "conv_id long, turn long, role string, text string")
    for r in conversations.repair_damaged(gone).collect():
        assert tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_rules_do_not_change_results(spark, talks):
    """Rules and squares give what the plain product of all symbols gives."""
    rng, grammar, plain = random.Random(8), conversations.Grammar(), conversations.Grammar()
    for pair in ("ua", "", "xx", "u", ""):
        grammar.add(pair)
    for _ in range(200):
        s = "".join(rng.choices("xsuaoSUAO", k=rng.randint(1, 12))) + "uaua" * rng.randint(0, 6)
        assert grammar.entries(s, 1) == plain.entries(s, 1)
    assert grammar.entries("x", 13) == plain.entries("x" * 13, 1)


def test_learned_rules_are_frequent_pairs(spark):
    strings = spark.createDataFrame([("suauaua", 50), ("uaua", 70), ("ox", 1)], "symbols string, count long")
    rules = conversations.learn(strings).rules
    assert rules[0][0] == "ua" and all("o" not in pair for pair, _ in rules)


def test_op12_sql_equals_brute_force(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF_SMALL}/conversations.parquet'")
    rows = con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    want = brute_repair(rows, True)
    assert {r[0]: r for r in con.execute(conversations.oracle_sql()).fetchall()} == want
    assert {r[0]: tuple(r) for r in queries.op12_conversation_repair(spark, SF_SMALL).collect()} == want


# --- lexical search ----------------------------------------------------------------------------------------------


def by_sql(docs, items):
    """The oracle's answer; ids of equal rows may swap, so ranks come with scores and sets of ids."""
    import pyarrow as pa

    con = duckdb.connect()
    kinds = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    con.register("documents", pa.Table.from_pylist([{"doc_id": k, "text": t} for k, t in docs], kinds))
    kinds = pa.schema([("item_id", pa.int64()), ("text", pa.string())])
    con.register("benchmark", pa.Table.from_pylist([{"item_id": k, "text": t} for k, t in items], kinds))
    return sorted(con.execute(lexical.oracle_sql()).fetchall(), key=repr)


def test_lexical_search_equals_sql(spark, monkeypatch):
    monkeypatch.setattr(lexical, "LEAF", 4)
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", 300)
    rng = random.Random(6)
    words = [f"w{k}" for k in range(60)] + ["Été", "É", "naïve", "don't", "10,000", "日本語", "\x1c", "A", "a"]
    docs = [(k, " ".join(rng.choices(words, k=int(rng.paretovariate(0.7))))) for k in range(400)]
    docs += [(500 + k, "w1 w2 w3 w4") for k in range(60)] + [(7, "w1"), (7, "w1"), (None, "w1 w2"), (600, None), (601, ""), (602, "!?"), (603, "w5 " * 50_000)]
    items = [(k, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for k in range(30)]
    items += [(30, "w1 w2 w3 w4"), (30, "w9"), (30, "w9"), (31, None), (32, ""), (33, "absent"), (None, "w1")]
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, n int, item_id string").repartition(3)
    i = spark.createDataFrame([(*r, 5) for r in items], "item_id long, text string, doc_id int")
    assert sorted(map(tuple, lexical.ranked_search(d, i).collect()), key=repr) == by_sql(docs, items)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 100)  # several blocks of items
    assert sorted(map(tuple, lexical.ranked_search(d, i).collect()), key=repr) == by_sql(docs, items)
    assert lexical.ranked_search(d.where("false"), i).collect() == []
    assert lexical.ranked_search(d, i.where("false")).collect() == []


def test_ball_tree_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    rows = [np.sort(rng.choice(50, rng.integers(1, 12), replace=False)) for _ in range(300)]
    rows += [np.arange(5)] * 300  # copies: a ball of radius about zero
    begin = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    impact = rng.integers(1, 10**9, begin[-1])
    impact[begin[300] :] = np.tile([1, 2, 3, 4, 5], 300)
    tree = lexical.BallTree(begin, np.concatenate(rows), impact, 50)
    items = [np.sort(rng.choice(50, 8, replace=False)) for _ in range(20)]
    bounds = tree.bounds(np.cumsum([0, *map(len, items)])[:-1], np.concatenate(items))
    for node, (low, high) in enumerate(zip(tree.low, tree.high)):
        for k, wanted in enumerate(items):
            exact = max(int(impact[begin[d] : begin[d + 1]][np.isin(rows[d], wanted)].sum()) for d in tree.order[low:high])
            assert exact <= bounds[node, k]
    best = lexical.Best(20, 10)
    scored = lexical.search(tree, list(range(600)), items, best)
    for wanted, kept in zip(items, best.kept):
        every = sorted((-int(impact[begin[d] : begin[d + 1]][np.isin(rows[d], wanted)].sum()), d) for d in range(600))
        assert kept == [(-s, d) for s, d in every[:10] if s < 0]
    assert scored < 0.8 * 20 * len(tree.leaves)  # the copies are never opened


def test_op13_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    assert sorted(map(tuple, queries.op13_lexical_search(spark, SF_SMALL).collect())) == sorted(con.execute(lexical.oracle_sql()).fetchall())
