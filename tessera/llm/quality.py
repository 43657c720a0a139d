"""Line-first quality rules.

Each line is judged on its own: lines of signs, of shouting, of navigation and
of boilerplate fail, as do lines that repeat an earlier one. Failing lines are
removed; a document that loses too much of its text this way is rejected, as is
one that the base rules reject.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import prepare

_SYMBOL = re.compile(r"[#*$%&|<>]")
_SYMBOL_BYTES = b"#*$%&|<>"
_SHOUT = re.compile(r"[!?]{2,}$")
#: Phrases that mark a line of site text. Fixed values.
BOILERPLATE = (
    "accept all cookies",
    "all rights reserved",
    "click here to",
    "cookie policy",
    "enable javascript",
    "javascript is disabled",
    "lorem ipsum",
    "privacy policy",
    "sign in to",
    "skip to content",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
    "this site uses cookies",
    "we use cookies",
)
_BOILERPLATE = re.compile("|".join(map(re.escape, BOILERPLATE)))


@dataclass(frozen=True)
class Rules:
    """Production limits; shares are of a line's words unless said otherwise."""

    min_words: int = 50
    max_repeat_percent: int = 50
    #: A line fails with more of its words carrying or being a sign.
    max_symbol_words: float = 0.3
    #: A line fails with more of its words ending in several ! or ?.
    max_shout_words: float = 0.3
    #: A line of at least so many letters fails with more of them upper case.
    min_case_letters: int = 20
    max_upper: float = 0.6
    #: A line fails with so many bars, arrows or dots between its words.
    min_separators: int = 3
    max_separator_words: float = 0.15
    #: A line of at most so many words fails if it holds a boilerplate phrase.
    boilerplate_words: int = 25
    #: A document is rejected when it loses more of its words.
    max_lost: float = 0.5


_SEPARATORS = {"|", "»", "›", ">", "•", "·", "/", "::"}


def line_fails(line: str, rules: Rules) -> bool:
    """Whether one line with at least a word fails a rule of its own."""
    words = line.split()
    n = len(words)
    if not n:
        return False
    if sum(w in _SEPARATORS for w in words) >= max(rules.min_separators, rules.max_separator_words * n):
        return True
    if _SYMBOL.search(line) and sum(_SYMBOL.search(w) is not None for w in words) > rules.max_symbol_words * n:
        return True
    if ("!!" in line or "??" in line or "!?" in line) and sum(_SHOUT.search(w) is not None for w in words) > rules.max_shout_words * n:
        return True
    if line != line.lower():
        letters = sum(map(str.isalpha, line))
        if letters >= rules.min_case_letters and sum(map(str.isupper, line)) > rules.max_upper * letters:
            return True
    return n <= rules.boilerplate_words and _BOILERPLATE.search(line.lower()) is not None


def repeat_words(words: list, size: int = 3) -> int:
    """Words that lie in a window of ``size`` words that the text holds twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    key = ids[:n]
    for k in range(1, size):
        key = key * len(number) + ids[k : n + k]
        if k + 1 < size and len(number) ** (k + 2) >= 1 << 62:  # keeps the next product in 64 bits
            key = np.unique(key, return_inverse=True)[1]
    _, at, times = np.unique(key, return_inverse=True, return_counts=True)
    inside = np.zeros(len(words) + 1, np.int64)
    first = np.flatnonzero(times[at] > 1)
    np.add.at(inside, first, 1)
    np.add.at(inside, first + size, -1)
    return int((np.cumsum(inside[:-1]) > 0).sum())


def judge(text: str | None, rules: Rules) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lost_words, kept, cleaned text)."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    word_chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = len(raw) - len(raw.translate(None, _SYMBOL_BYTES))
    repeats = repeat_words(words)
    lines = raw.split(b"\n")
    seen, kept_lines, duplicates, lost = set(), [], 0, 0
    for line in lines:
        in_line = len(line.split())
        if not in_line:
            kept_lines.append(line)
            continue
        again = line in seen
        seen.add(line)
        duplicates += again
        if again or line_fails(line.decode(), rules):
            lost += in_line
        else:
            kept_lines.append(line)
    failed = n < rules.min_words or 100 * repeats > rules.max_repeat_percent * n
    kept = not failed and lost <= rules.max_lost * n
    cleaned = b"\n".join(kept_lines).decode() if lost else text
    return n, word_chars, symbols, duplicates, repeats, failed, lost, kept, cleaned


_FIELDS = [
    ("n_words", pa.int64()),
    ("word_chars", pa.int64()),
    ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()),
    ("base_failed", pa.bool_()),
    ("lost_words", pa.int64()),
    ("kept", pa.bool_()),
    ("cleaned", pa.string()),
]
SCHEMA = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, lost_words bigint, kept boolean, cleaned string"


def quality_rules(
    docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text", with_text: bool = True
) -> DataFrame:
    """Counts, verdict and cleaned text of every row of ``docs``; no shuffle.

    * Null or empty text: no words, so ``base_failed`` and not kept; cleaned text is empty.
    * Words are cut at ASCII white space. Lines end at \\n; lines without a word
      are never duplicates, and stay.
    * A line equal to an earlier one of its text counts as duplicate and is removed.
    * Repeated rows and null ids: each row is judged on its own.
    * An empty table gives no rows; other columns are not read.
    """
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    fields = _FIELDS if with_text else _FIELDS[:-1]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [judge(t, rules)[: len(fields)] for t in b.column(1).to_pylist()]
            cols = [pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(fields)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=[id_col, *(f for f, _ in fields)])

    schema = SCHEMA if with_text else SCHEMA.rsplit(",", 1)[0]
    return docs.select(id_col, text_col).mapInArrow(each, f"`{id_col}` {kind}, {schema}")


def keep_clean(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` without the rejected documents and without the failing lines of the others.

    The columns stay as they are; ``chars_col``, where there is one, follows the text.

    * Null and empty texts have no word and are rejected, whatever their other columns hold.
    * Repeated rows and null ids: each row is judged on its own, equal texts alike.
    * Other columns may have any name and pass through. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    names = docs.columns
    at = names.index(text_col)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [judge(t, rules) for t in b.column(at).to_pylist()]
            keep = pa.array([r[7] for r in found], pa.bool_())
            cols = list(b.columns)
            cols[at] = pa.array([r[8] for r in found], cols[at].type)
            if chars_col in names:
                k = names.index(chars_col)
                cols[k] = pa.array([len(r[8]) for r in found], cols[k].type)
            yield pa.RecordBatch.from_arrays(cols, names=names).filter(keep)

    return docs.mapInArrow(each, docs.schema)
