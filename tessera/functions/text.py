"""Text column expressions (no UDFs): cleaning, stop words, word counts, slices."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default English stop-word list, in its original order;
# results must equal the reference's.
STOPWORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've", "you'll", "you'd", "your",
    "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she", "she's", "her", "hers", "herself", "it",
    "it's", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which", "who", "whom", "this",
    "that", "that'll", "these", "those", "am", "is", "are", "was", "were", "be", "been", "being", "have", "has",
    "had", "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as",
    "until", "while", "of", "at", "by", "for", "with", "about", "against", "between", "into", "through", "during",
    "before", "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all", "any", "both", "each",
    "few", "more", "most", "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too",
    "very", "s", "t", "can", "will", "just", "don", "don't", "should", "should've", "now", "d", "ll", "m", "o", "re",
    "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't", "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't",
    "hasn", "hasn't", "haven", "haven't", "isn", "isn't", "ma", "mightn", "mightn't", "mustn", "mustn't", "needn",
    "needn't", "shan", "shan't", "shouldn", "shouldn't", "wasn", "wasn't", "weren", "weren't", "won", "won't",
    "wouldn", "wouldn't",
]

# ASCII punctuation padded by the cleaner, and the slice terms.
PUNCTUATION_CLASS = r"""([!"'#$%&()*\+,-./:;<=>?@\\\[\]^_`{|}~])"""
LLM_TERMS = ["transformer", "llm", "bert"]
NLP_TAG = "natural-language-processing"

# A "word character" as Python's Unicode ``\w`` defines it (letters, numbers,
# underscore). Java's (?U)\w also admits combining marks, so it is spelled out.
WORD = r"[\p{L}\p{N}_]"
# White space as Python's Unicode ``\s`` defines it, as a class and in full.
SPACE = r"[\t-\r\x1c- \x85\p{Z}]"
SPACE_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
TOKEN_PATTERN = rf"({WORD}+{SPACE}*|[^\p{{L}}\p{{N}}_]+)"
_WORD_RE = re.compile(r"^\w+$")


def effective_stopwords(stopwords) -> list[str] | None:
    """Words that ordered-alternation stop-word removal can actually remove.

    With pattern ``\\b(w1|w2|...)\\b\\s*`` an entry made of word characters
    removes exactly a maximal word run. An entry with a non-word character
    (``don't``) can only match if its word prefix is not listed earlier: when
    it is, the earlier alternative always wins at that position, so the
    entry is dead. Returns the live word set, or ``None`` when some live
    entry needs the general regex path.
    """
    seen: list[str] = []
    live: list[str] = []
    for w in stopwords:
        if _WORD_RE.match(w):
            live.append(w)
        else:
            head = re.match(r"^\w*", w).group(0)
            if not (head and head in seen):
                return None
        seen.append(w)
    return live


def remove_stopwords(text: Column, stopwords=STOPWORDS) -> Column:
    """ST-2 on lower-cased text: every stop word (a whole Unicode word run)
    and the white space after it become one space. Tokenizes into words with
    their white space and runs of other characters and drops listed words
    with a hash-set ``IN``; falls back to the alternation regex (entries
    quoted) for lists whose entries span non-word characters."""
    live = effective_stopwords(list(stopwords))
    if live is None:
        pattern = r"(?U)\b(" + "|".join(re.escape(w) for w in stopwords) + rf")\b{SPACE}*"
        return F.regexp_replace(text, pattern, " ")
    if not live:
        return text
    tokens = F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), 1)
    stopset = [F.lit(w) for w in dict.fromkeys(live)]
    listed = lambda t: F.rtrim(t, F.lit(SPACE_CHARS)).isin(*stopset)
    return F.array_join(F.transform(tokens, lambda t: F.when(listed(t), F.lit(" ")).otherwise(t)), "")


def drop_words(text: Column, words: list[str]) -> Column:
    """The words of lower-cased text that are not listed, with one space for all that is between them.

    What :func:`remove_stopwords` leaves differs from this in white space and
    in other signs between words only, which ST-4 makes one space anyway."""
    spaced = F.when(
        F.octet_length(text) == F.char_length(text), F.regexp_replace(text, "[^A-Za-z0-9_]+", " ")  # the plain class is faster
    ).otherwise(F.regexp_replace(text, r"[^\p{L}\p{N}_]+", " "))
    listed = [F.lit(w) for w in dict.fromkeys(words)]
    return F.array_join(F.filter(F.split(spaced, " "), lambda w: ~w.isin(*listed)), " ")


def pad_punctuation(text: Column) -> Column:
    """ST-3: surround each ASCII punctuation mark with spaces."""
    return F.regexp_replace(text, PUNCTUATION_CLASS, " $1 ")


def strip_non_alnum(text: Column) -> Column:
    """ST-4: runs of characters outside [A-Za-z0-9] become one space."""
    return F.regexp_replace(text, "[^A-Za-z0-9]+", " ")


def collapse_spaces(text: Column) -> Column:
    """ST-5: runs of spaces become one; strip the ends."""
    return F.trim(F.regexp_replace(text, " +", " "))


def remove_links(text: Column) -> Column:
    """ST-6: drop ``http`` followed by non-space characters."""
    return F.regexp_replace(text, r"http\S+", "")


def clean_text(text: Column, stopwords=STOPWORDS, links_first: bool = False) -> Column:
    """ST-7: lower -> stop words -> punctuation -> non-alphanumerics -> spaces
    -> trim -> links, in the reference's order (links last, quirk Q1).

    ST-3 is left out of the composition: it only inserts spaces around
    characters that ST-4 turns into spaces anyway, and ST-4 already leaves
    single spaces, so the output is identical and two regex passes are saved.
    Stop words that are whole words are dropped by :func:`drop_words` for the
    same reason. ``links_first=True`` removes links before anything else instead.
    """
    t = F.lower(text)
    if links_first:
        t = remove_links(t)
    live = effective_stopwords(list(stopwords))
    t = drop_words(t, live) if live else remove_stopwords(t, stopwords)
    t = F.trim(strip_non_alnum(t))
    if not links_first:
        t = remove_links(t)
    return t


def word_count(text: Column) -> Column:
    """ST-9: number of whitespace-separated tokens (Unicode whitespace)."""
    return F.regexp_count(text, F.lit(r"(?U)\S+"))


def any_term(text: Column, terms) -> Column:
    """ST-8: case-insensitive substring match of any term."""
    low = F.lower(text)
    return F.exists(F.array(*[F.lit(t.lower()) for t in terms]), lambda s: F.contains(low, s))


def slice_nlp_llm(tag: Column, text: Column, tag_text: str = NLP_TAG, terms=LLM_TERMS) -> Column:
    """FP11: tag contains ``tag_text`` and the text mentions any term."""
    return F.contains(tag, F.lit(tag_text)) & any_term(text, terms)


def slice_short_text(text: Column, max_words: int = 8) -> Column:
    """FP12: fewer than ``max_words`` whitespace tokens."""
    return word_count(text) < F.lit(max_words)


def text_feature(title: Column, description: Column) -> Column:
    """FP1: ``title + " " + description`` (NULL-propagating, like pandas NaN)."""
    return F.concat(title, F.lit(" "), description)


def name_from_path(path: Column) -> Column:
    """ST-12: last path component for ``/`` and ``\\``; trailing separators ignored."""
    return F.regexp_extract(path, r"([^/\\]+)[/\\]*$", 1)
