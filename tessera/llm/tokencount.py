"""Token counts by finite-state tokenizer compilation.

A byte-level BPE vocabulary becomes two deterministic transducers, run one after the other:

* The *cutter* reads classes of characters with one character of lookahead and marks where the pre-tokenizer starts
  a new part. It has eight states, and a chunk of text acts as a map from states to states. The maps of the chunks of
  all texts of a batch are found side by side, composed by a parallel prefix scan, and a second pass from the states
  then known writes the marks.
* The *merger* reads the bytes of a part. Its state holds the suffixes of the bytes read that may still grow into a
  longer token, and for each of them the last token before it. Every transition is annotated with the number of
  tokens that it settles, every state with the tokens still pending when a part ends there. What comes next depends
  on such a state alone, as tokens are the encoding of a text if and only if each two neighbours are the encoding of
  their bytes. Transitions are determined when they are first needed, and a worker keeps them.

Parts are short, so they start most chunks of the merger. A part above ``LONG`` bytes is cut into chunks whose state
maps grow from guessed states until they hold every state that can arrive; they too are composed by doubling.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tessera.llm.common import prepare

LIMIT = 512
#: Characters of a cutter's chunk, and bytes that a merger's chunk has at least.
CHUNK = 256
#: Bytes of a part above which it is cut into chunks.
LONG = 2048
#: Bytes of text stepped at once; a longer text makes a step of its own.
STEP_BYTES = 4 << 20
#: States of the merger that a worker keeps; beyond it they are determined anew, which changes no count.
MOST_STATES = 400_000

# Classes of characters, fixed by the pattern of the pre-tokenizer:
# 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
END, SPACE, BLANK, DIGIT, SIGN, QUOTE, STMD, RV, EL, EE, LETTER = range(11)
_OWN = {" ": SPACE, "'": QUOTE, "r": RV, "v": RV, "l": EL, "e": EE, **dict.fromkeys("stmd", STMD)}
_LETTERS = {STMD, RV, EL, EE, LETTER}

# States of the cutter: what the character before belongs to.
FRESH, BLANKS, JOINS, WORD, NUMBER, SIGNS, OPENS, SHORT = range(8)


def _cut(state: int, c: int, after: int) -> tuple[bool, int]:
    """Whether a part starts at a character of class ``c``, and the next state."""
    if c in (SPACE, BLANK):
        if after in (SPACE, BLANK, END):
            return state != BLANKS, BLANKS
        return True, JOINS if c == SPACE else FRESH  # the last blank of a run stands apart
    if c in _LETTERS:
        if state == SHORT:
            return False, FRESH
        if state == OPENS and c == STMD:
            return False, FRESH
        if state == OPENS and (c, after) in ((RV, EE), (EL, EL)):
            return False, SHORT
        return state not in (JOINS, WORD), WORD
    if c == DIGIT:
        return state not in (JOINS, NUMBER), NUMBER
    if state in (JOINS, SIGNS, OPENS):
        return False, SIGNS
    return True, OPENS if c == QUOTE else SIGNS


class Cutter:
    """The cutter's tables by symbol: (first of a text, class, next class) as one number.

    A chunk's map of the eight states is one of the few maps that symbols make when they follow each other, so it
    is kept as a number too: ``then[map, symbol]`` and ``after[map, map]`` give the map of both in a row.
    """

    def __init__(self):
        move, mark = np.zeros((2 * 121, 8), np.int64), np.zeros((2 * 121, 8), bool)
        for c in range(1, 11):
            for after in range(11):
                for state in range(8):
                    mark[c * 11 + after, state], move[c * 11 + after, state] = _cut(state, c, after)
                mark[121 + c * 11 + after], move[121 + c * 11 + after] = True, _cut(FRESH, c, after)[1]
        move[[k for k in range(242) if k % 121 < 11]] = np.arange(8)  # padding changes nothing
        maps = {tuple(range(8)): 0}
        then = []
        for m in (queue := list(maps)):
            row = []
            for s in range(242):
                made = tuple(move[s, list(m)].tolist())
                if made not in maps:
                    maps[made] = len(maps)
                    queue.append(made)
                row.append(maps[made])
            then.append(row)
        self.move, self.mark = move.astype(np.uint8).reshape(-1), mark.reshape(-1)
        self.then = np.array(then, np.int16).reshape(-1)
        self.maps = np.array(queue, np.uint8)
        self.after = np.array([[maps[tuple(b[x] for x in a)] for b in queue] for a in queue], np.int16)

    def starts(self, symbols: np.ndarray) -> np.ndarray:
        """The state at the start of each chunk; a row of ``symbols`` is a step of all chunks."""
        chunk = np.zeros(symbols.shape[1], np.int32)
        for s in symbols:
            chunk = self.then[chunk * 242 + s].astype(np.int32)
        d = 1
        while d < len(chunk):  # parallel prefix scan: chunk[k] becomes the map of chunks 0 to k
            chunk[d:] = self.after[chunk[:-d], chunk[d:]]
            d *= 2
        return np.append(np.uint8(FRESH), self.maps[chunk[:-1], FRESH])

    def marks(self, symbols: np.ndarray) -> np.ndarray:
        """Whether a part starts at each symbol, in the shape of ``symbols``."""
        state, out = self.starts(symbols).astype(np.int32), np.empty(symbols.shape, bool)
        for k, s in enumerate(symbols):
            at = s * 8 + state
            out[k] = self.mark[at]
            state = self.move[at].astype(np.int32)
        return out


def _classes(pre_tokenizer) -> np.ndarray:
    """The class of every code point, as the tokenizer's own Unicode tables have it.

    Two versions of Unicode at hand agree on all but some thousand code points,
    and the pre-tokenizer itself is asked about these.
    """
    out = np.full(0x110000, SIGN, np.uint8)
    letter, number, blank = regex.compile(r"\p{L}"), regex.compile(r"\p{N}"), regex.compile(r"\s")
    asked = []
    for cp in range(0x110000):
        kind = unicodedata.category(c := chr(cp))[0]
        if kind == "L":
            out[cp] = LETTER
        elif kind == "N":
            out[cp] = DIGIT
        elif kind == "C" and (letter.match(c) or number.match(c)):
            asked.append(cp)
        elif kind in "ZC" and blank.match(c):
            out[cp] = BLANK
    for k in range(0, len(asked), 400):
        some = asked[k : k + 400]
        for lead, kind in (("a", LETTER), ("1", DIGIT)):
            starts = {at for _, (at, _) in pre_tokenizer.pre_tokenize_str("".join("\n" + lead + chr(cp) for cp in some))}
            out[[cp for j, cp in enumerate(some) if 3 * j + 2 not in starts]] = kind
    for c, kind in _OWN.items():
        out[ord(c)] = kind
    return out


class Merger:
    """The transducer over the bytes of a part; state 0 has read nothing.

    Transitions lie in one open-addressed table by ``state * 256 + byte``, as nearly all of the possible ones are
    never taken.
    """

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        self.ranks = {pair: k for k, pair in enumerate(merges)}
        names = {t[:k]: None for t in vocabulary for k in range(len(t) + 1)}
        self.names = list(names)  # tokens and their beginnings, by number
        self.numbers = {name: k for k, name in enumerate(self.names)}
        self.is_token = np.zeros(len(names), bool)
        self.is_token[[self.numbers[t] for t in vocabulary]] = True
        self.grows = np.zeros(len(names), bool)  # beginnings of longer tokens
        self.grows[[self.numbers[t[:k]] for t in vocabulary for k in range(len(t))]] = True
        self.is_token, self.grows = self.is_token.tolist(), self.grows.tolist()
        self.made = {self.numbers[t]: (-1, -1, -1) for t in vocabulary}  # left part, right part, rank
        self.across: dict[int, int] = {}
        for k, (a, b) in enumerate(merges):
            left, right, whole = self.numbers[a], self.numbers[b], self.numbers[a + b]
            if self.made[whole][2] >= 0 or max(self.made[left][2], self.made[right][2]) >= k:
                raise ValueError("merges must make each token once, from tokens that earlier merges made")
            self.made[whole], self.across[left << 32 | right] = (left, right, k), k
        self.spines: tuple[dict, dict] = {}, {}
        self.fits: dict[int, bool] = {}
        self.clear()

    def clear(self) -> None:
        """Forget all states; those that are needed again are determined again."""
        self.fits.clear()
        self.ids: dict[bytes, int] = {}
        self.states: list[bytes] = []
        self.pending = np.zeros(1024, np.int32)
        self.taken = 0
        self._table(1 << 14)
        self._state([self.numbers[b""], -1, 0])

    def _table(self, size: int) -> None:
        self.key, self.move, self.emit = np.full(size, -1, np.int64), np.zeros(size, np.int32), np.zeros(size, np.int32)

    def encode(self, part: bytes) -> list[bytes]:
        """The tokens of a part by merging pairs in order of rank."""
        found = [part[k : k + 1] for k in range(len(part))]
        while len(found) > 1:
            rank, k = min((self.ranks.get(pair, 1 << 30), k) for k, pair in enumerate(zip(found, found[1:])))
            if rank == 1 << 30:
                break
            found[k : k + 2] = [found[k] + found[k + 1]]
        return found

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """What stands at one end of a token while it is built, each with the rank of the merge that ends it."""
        if (found := self.spines[side].get(token)) is None:
            found, ends, at = [], 1 << 40, token
            while at >= 0:
                found.append((at, ends))
                ends, at = self.made[at][2], self.made[at][side]
            self.spines[side][token] = found
        return found

    def _fit(self, before: int, token: int) -> bool:
        """Whether ``token`` can follow ``before`` (-1: nothing) in an encoding.

        Merges go by rank, and of one rank from the left, so the two stay apart if no merge across their border
        comes before the merges that take its two sides away.
        """
        if (ok := self.fits.get(key := (before + 1) << 32 | token)) is None:
            if before < 0:
                ok = self.encode(self.names[token]) == [self.names[token]]
            else:
                ok = self._fit(-1, token) and not any(
                    (rank := self.across.get(x << 32 | y)) is not None and rank < x_ends and rank <= y_ends
                    for x, x_ends in self._spine(before, 1)
                    for y, y_ends in self._spine(token, 0)
                )
            self.fits[key] = ok
        return ok

    def _state(self, items: list[int]) -> int:
        """The number of a state: suffix that may grow, last token before it, tokens since the first, of each."""
        key = array("i", items).tobytes()
        if (k := self.ids.get(key)) is None:
            k = self.ids[key] = len(self.states)
            self.states.append(key)
            if k >= len(self.pending):
                self.pending = np.concatenate([self.pending, np.zeros_like(self.pending)])
            self.pending[k] = items[-1]
        return k

    def _slots(self, at: np.ndarray) -> np.ndarray:
        return ((at * np.int64(0x1E3779B97F4A7C15)) >> np.int64(20)) & np.int64(len(self.key) - 1)

    def _put(self, at: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        for x, slot, m, e in zip(at.tolist(), self._slots(at).tolist(), move.tolist(), emit.tolist()):
            while self.key[slot] >= 0:
                slot = (slot + 1) % len(self.key)
            self.key[slot], self.move[slot], self.emit[slot] = x, m, e

    def determine(self, at: int) -> tuple[int, int]:
        """The state that a byte leads to, and the tokens that this settles."""
        old, byte, items, last, count = array("i"), bytes([at & 255]), [], -1, 0
        old.frombytes(self.states[at >> 8])
        for suffix, before, n in zip(old[::3], old[1::3], old[2::3]):
            if (longer := self.numbers.get(self.names[suffix] + byte)) is None:
                continue
            if last < 0 and self.is_token[longer] and self._fit(before, longer):
                last, count = longer, n + 1
            if self.grows[longer]:
                items += [longer, before, n]
        items += [self.numbers[b""], last, count]
        base = items[2]
        items[2::3] = [n - base for n in items[2::3]]
        return self._state(items), base

    def _find(self, at: np.ndarray) -> np.ndarray:
        """The places of transitions in the table; determines those that are missing."""
        while True:
            slot = self._slots(at)
            seen = self.key[slot]
            wrong = np.flatnonzero(seen != at)
            missing = []
            while len(wrong):
                empty = seen[wrong] < 0
                if empty.any():
                    missing.append(at[wrong[empty]])
                    wrong = wrong[~empty]
                slot[wrong] = (slot[wrong] + 1) & (len(self.key) - 1)
                seen[wrong] = self.key[slot[wrong]]
                wrong = wrong[seen[wrong] != at[wrong]]
            if not missing:
                return slot
            new = np.unique(np.concatenate(missing))
            made = np.array([self.determine(x) for x in new.tolist()], np.int32).T
            self.taken += len(new)
            if 2 * self.taken > len(self.key):
                held = self.key >= 0
                kept = self.key[held], self.move[held], self.emit[held]
                self._table(len(self.key) * 4)
                self._put(*kept)
            self._put(new, *made)

    def run(self, data: np.ndarray, fresh: np.ndarray, start: np.ndarray, size: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Step chunks side by side; their last states and the tokens that they settle.

        Where ``fresh`` marks a byte, the part before ends and a new one begins.
        """
        order = np.argsort(-size, kind="stable")
        start, size, state = start[order], size[order], state[order].astype(np.int64)
        count = np.zeros(len(start), np.int64)
        active = np.searchsorted(-size, -np.arange(size.max(initial=0)), side="left")  # chunks longer than k bytes
        for k, n in enumerate(active.tolist()):
            at, now = start[:n] + k, state[:n]
            if len(new := np.flatnonzero(fresh[at])):
                count[new] += self.pending[now[new]]
                now[new] = 0
            slot = self._find(now * 256 + data[at])
            count[:n] += self.emit[slot]
            state[:n] = self.move[slot]
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return state[back], count[back]

    def long_part(self, data: np.ndarray) -> int:
        """The tokens of one long part, from the state maps of its chunks."""
        begins = np.arange(0, len(data), CHUNK)
        none = np.zeros(len(data), bool)
        # guess: the state after the bytes just before, as if a part began there
        lead = np.maximum(begins - 64, 0)
        guess, _ = self.run(data, none, lead, begins - lead, np.zeros(len(begins), np.int64))
        maps: dict[tuple[int, int], tuple[int, int]] = {}
        todo = list(enumerate(guess.tolist()))
        while todo:
            c, s = np.array(todo).T
            ends, counts = self.run(data, none, begins[c], np.minimum(CHUNK, len(data) - begins[c]), s)
            maps.update(zip(todo, zip(ends.tolist(), counts.tolist())))
            todo = list(dict.fromkeys((k + 1, e) for (k, _), e in zip(todo, ends.tolist()) if k + 1 < len(begins) and (k + 1, e) not in maps))
        nodes = {key: k for k, key in enumerate(maps)}
        goes = np.array([nodes.get((k + 1, e), -1) for (k, _), (e, _) in maps.items()] + [-1])
        total = np.array([n + (int(self.pending[e]) if k + 1 == len(begins) else 0) for (k, _), (e, n) in maps.items()] + [0])
        goes[goes < 0] = len(nodes)  # the end, which goes to itself
        for _ in range(len(begins).bit_length()):
            total, goes = total + total[goes], goes[goes]
        return int(total[nodes[0, 0]])


class Counter:
    """Token counts of texts, compiled from a ``tokenizers`` file of byte-level BPE."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("a byte-level BPE without normalization is needed")
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in the file
        letters = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(sorted({*range(256)} - {*shown}))}
        raw = lambda token: bytes(letters[c] for c in token)
        added = {t["content"] for t in spec["added_tokens"]}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.merger = Merger({raw(t): i for t, i in spec["model"]["vocab"].items() if t not in added}, [(raw(a), raw(b)) for a, b in pairs])
        self.classes = _classes(Tokenizer.from_file(path).pre_tokenizer)
        self.cutter = Cutter()
        self.added = re.compile(b"|".join(re.escape(t.encode()) for t in sorted(added, key=len, reverse=True))) if added else None

    def marks(self, data: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where parts start among the bytes of texts that begin at ``first``."""
        at = np.flatnonzero((data & 0xC0) != 0x80)
        cp = data[at].astype(np.int32)
        for size, low, mask in ((2, 0xC0, 0x1F), (3, 0xE0, 0x0F), (4, 0xF0, 0x07)):
            if len(wide := np.flatnonzero((cp >= low) & (cp < (0xE0, 0xF0, 0xF8)[size - 2]) & (data[at] >= low))):
                value = cp[wide] & mask
                for k in range(1, size):
                    value = (value << 6) | (data[at[wide] + k] & 0x3F)
                cp[wide] = -value  # not a lead byte any more
        kind = self.classes[np.abs(cp)].astype(np.int16)
        starts = np.searchsorted(at, first)
        after = np.append(kind[1:], END)
        after[starts[1:] - 1] = END
        symbol = kind * 11 + after
        symbol[starts] += 121
        rows = -(-len(symbol) // CHUNK)
        padded = np.zeros(rows * CHUNK, np.int32)
        padded[: len(symbol)] = symbol
        found = self.cutter.marks(np.ascontiguousarray(padded.reshape(rows, CHUNK).T))
        out = np.zeros(len(data), bool)
        out[at[found.T.reshape(-1)[: len(at)]]] = True
        return out

    def pieces(self, data: np.ndarray, first: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """Tokens of each of ``texts`` texts, given in non-empty pieces that begin at ``first``."""
        out = np.zeros(texts, np.int64)
        if not len(first):
            return out
        fresh = self.marks(data, first)
        parts = np.append(np.flatnonzero(fresh), len(data))
        sizes = np.diff(parts)
        long = np.flatnonzero(sizes > LONG)
        cut = np.searchsorted(parts, np.arange(0, len(data), CHUNK))
        lanes = np.unique(np.concatenate([parts[cut[cut < len(sizes)]], first, parts[long], parts[long + 1]]))
        lanes = lanes[lanes < len(data)]
        size = np.diff(np.append(lanes, len(data)))
        of = owner[np.searchsorted(first, lanes, side="right") - 1]
        whole = np.isin(lanes, parts[long])
        state, count = self.merger.run(data, fresh, lanes[~whole], size[~whole], np.zeros((~whole).sum(), np.int64))
        np.add.at(out, of[~whole], count + self.merger.pending[state])
        for k in np.flatnonzero(whole):
            out[of[k]] += self.merger.long_part(data[lanes[k] : lanes[k] + size[k]])
        return out

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        k = 0
        while k < len(texts):
            if len(self.merger.states) > MOST_STATES:
                self.merger.clear()
            end, room = k, STEP_BYTES
            while end < len(texts) and (end == k or len(texts[end]) <= room):
                room -= len(texts[end])
                end += 1
            kept, owner = [], []
            for j in range(k, end):
                cut = self.added.split(texts[j]) if self.added else [texts[j]]
                out[j] += len(cut) - 1
                kept += (some := [c for c in cut if c])
                owner += [j - k] * len(some)
            first = np.cumsum([0, *map(len, kept)])[:-1]
            out[k:end] += self.pieces(np.frombuffer(b"".join(kept), np.uint8), first, np.array(owner, np.int64), end - k)
            k = end
        return out


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def vocabulary_path() -> str:
    """The public tokenizer file of the contract, where this machine has it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes, n_tokens, over_limit) of whole texts, a row for each row of ``docs``.

    Counts are those of the tokenizer file with its added tokens split out of the text first, and without any
    token put around it.

    * Null or empty text: no bytes, no tokens, not over the limit.
    * Null ids, repeated rows and ids: each row is counted on its own. Nothing is ranked, so there are no ties.
    * Very long texts are counted whole: in chunks, by one task, in memory in proportion to the text.
    * An empty table gives no rows; other columns are not read, whatever their names.
    """
    prepare(docs.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for b in batches:
            texts = [t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]
            n = count(texts)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(n), pa.array(n > limit)],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(each, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
