"""DuckDB spellings of shared expressions used by oracle SQL."""

from __future__ import annotations

from tessera.functions.text import LLM_TERMS, STOPWORDS, effective_stopwords
from tessera.plans.views import SLICE_TAG


def sql_str_list(items) -> str:
    return "[" + ", ".join("'" + s.replace("'", "''") + "'" for s in items) + "]"


def sql_clean_text(expr: str) -> str:
    """ST-7 in DuckDB: tokenized stop-word removal, then the regex steps."""
    live = effective_stopwords(STOPWORDS)
    stop = sql_str_list(dict.fromkeys(live))
    toks = rf"regexp_extract_all(lower({expr}), '([\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+)', 1)"
    kept = f"array_to_string(list_transform({toks}, lambda t: CASE WHEN list_contains({stop}, t) THEN ' ' ELSE t END), '')"
    return rf"regexp_replace(trim(regexp_replace({kept}, '[^A-Za-z0-9]+', ' ', 'g')), 'http\S+', '', 'g')"


def sql_word_count(expr: str) -> str:
    return rf"len(regexp_extract_all({expr}, '\S+'))"


def sql_slice_nlp_llm(tag: str, text: str) -> str:
    terms = " OR ".join(f"contains(lower({text}), '{t}')" for t in LLM_TERMS)
    return f"(contains({tag}, '{SLICE_TAG}') AND ({terms}))"


def sql_slice_short(text: str) -> str:
    return f"({sql_word_count(text)} < 8)"
