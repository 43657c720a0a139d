"""License scans by diagonal voting, in DataFrame operations only.

A text's words are hashed in rolling k-grams, which are joined to the positions
of the same k-grams in the license templates. A match votes for the diagonal
(word of the text minus word of the template) that it lies on. Votes are added
up per diagonal, neighbouring diagonals (words put in or left out) are merged,
and a merged span is verified by the template words it covers and its length.
Verified spans of notices that lie on the same words compete: licenses share most
of their wording, and the one whose template differs least from the text is meant.

The template table is a parameter, so its size is known before the join; it is
broadcast below ``BROADCAST_GRAMS`` rows and joined by shuffle above. Only
matches are shuffled, never texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import prepare

#: Words of a gram; the shortest phrase has as many.
K = 3
BROADCAST_GRAMS = 100_000
#: Everything between words: ASCII signs and white space.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Phrases whose words must stand consecutively, and their labels. Fixed values.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Opening passages and notices of public licenses, and their labels. Fixed values.
NOTICES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("mit", "Released under the MIT License."),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl-3", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License"),
    ("agpl-3", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
]

#: Labels from the strictest: of spans that fit a text equally well, the first one stands.
STRICTEST = ["agpl-3", "gpl-3", "gpl-2", "lgpl-3", "cc-by-nc", "cc-by-sa", "mpl-2", "apache-2", "cc-by", "bsd", "isc", "mit", "unlicense", "cc0"]


def words_of(text: str) -> list[str]:
    """Words of a template, cut as the operator cuts texts."""
    return [w for w in re.split(SEPARATOR, text.translate(str.maketrans(UPPER, LOWER))) if w]


@dataclass(frozen=True)
class Templates:
    """Phrases found exactly, notices found approximately."""

    phrases: dict[str, str] = field(default_factory=lambda: dict(PHRASES))
    notices: list[tuple[str, str]] = field(default_factory=lambda: list(NOTICES))
    #: Diagonals so far apart are one span.
    max_shift: int = 3
    #: Share of a notice's words that a span must cover.
    min_cover: float = 0.8
    #: Times a notice's length that a span may have.
    max_stretch: float = 1.25

    #: Share of the shorter of two spans on the same words from which they compete.
    min_overlap: float = 0.5

    def longest(self) -> int:
        """Words that a verified span of a notice can have."""
        return int(max([len(words_of(text)) for _, text in self.notices], default=K) * self.max_stretch) + 1

    def strictness(self, label: str) -> int:
        return STRICTEST.index(label) if label in STRICTEST else len(STRICTEST)

    def grams(self) -> list[tuple]:
        """(template, label, base, strictness, n words, position, words of the gram)."""
        texts = [(label, True, text) for text, label in self.phrases.items()]
        texts += [(label, False, text) for label, text in self.notices]
        out = []
        for k, (label, base, text) in enumerate(texts):
            words = words_of(text)
            if len(words) < K:
                raise ValueError(f"a template needs {K} words: {text!r}")
            out += [(k, label, base, self.strictness(label), len(words), p, *words[p : p + K]) for p in range(len(words) - K + 1)]
        return out


def _words(text):
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, SEPARATOR), "")


def _fittest(spans: DataFrame, t: Templates) -> DataFrame:
    """Spans that no better one of another label contests.

    Better is fewer words of difference (words of the span that the template does not explain, and words of the
    template that the span lacks), then more words covered, then the stricter label. Spans that can meet share one of
    two stretches of ``longest`` words, so a text of any length is compared in small groups.
    """
    length = F.col("end") - F.col("first")
    off = F.greatest(length - F.col("covered"), F.lit(0)) + F.col("size") - F.col("covered")
    order = F.struct(off.alias("off"), (-F.col("covered")).alias("fewer"), "strict", "template", F.col("first").alias("place"))
    spans = spans.withColumn("me", F.struct("label", "first", "end", order.alias("order")))
    stretches = F.sequence(F.floor(F.col("first") / t.longest()), F.floor((F.col("end") - 1) / t.longest()))
    columns = [c for c in spans.columns if c not in ("hits", "me")]
    listed = spans.withColumn("stretch", F.explode(stretches)).groupBy("id", "key", "stretch").agg(
        F.collect_list(F.struct(*columns, "me")).alias("all")
    )
    each = listed.select("all", F.explode("all").alias("s"))

    def contests(b):
        both = F.least(b.me.end, F.col("s.me.end")) - F.greatest(b.me["first"], F.col("s.me.first"))
        shorter = F.least(b.me.end - b.me["first"], F.col("s.me.end") - F.col("s.me.first"))
        return (b.me.label != F.col("s.me.label")) & (both > shorter * t.min_overlap) & (b.me.order < F.col("s.me.order"))

    judged = each.select("s.*", F.exists("all", contests).alias("beaten"))
    return judged.groupBy(*columns).agg(F.bool_or("beaten").alias("beaten")).where(~F.col("beaten"))


def license_scan(
    docs: DataFrame, templates: Templates = Templates(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Licenses of every row of ``docs``: (id_col, n_words, n_base, first_word,
    last_word, base_labels, labels, score, n_spans).

    ``n_base`` counts all places where a phrase's words stand in a row, and
    ``first_word``/``last_word`` are their smallest and largest start (null if
    there is none). ``labels`` adds the notices whose spans are verified;
    ``score`` is 1 where a phrase stands, else the largest share of a notice
    that a verified span covers, else 0; ``n_spans`` counts verified spans.

    * Notices on the same words: only the label of the one that differs least
      from the text (``_fittest``). Base phrases always count.
    * Null or empty text, or one of fewer than three words: no match, labels
      are empty strings, score 0.
    * Repeated rows: each gets the same result. Rows that share an id but not
      the text are told apart by the text's hash.
    * Null ids are kept. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    t = templates
    grams = t.grams()
    table = spark.createDataFrame(grams, "template int, label string, base boolean, strict int, size int, at int, w0 string, w1 string, w2 string")
    table = table.withColumn("gram", F.xxhash64("w0", "w1", "w2"))
    table = F.broadcast(table) if len(grams) <= BROADCAST_GRAMS else table

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumns({"key": F.xxhash64(F.coalesce("text", F.lit(""))), "words": _words(F.col("text"))})
    shifted = [F.slice("words", k + 1, F.greatest(F.size("words") - (K - 1), F.lit(0))).alias(f"w{k}") for k in range(K)]
    rolled = rows.select("id", "key", F.posexplode(F.arrays_zip(*shifted)).alias("pos", "g"))
    rolled = rolled.select("id", "key", "pos", F.xxhash64("g.w0", "g.w1", "g.w2").alias("gram"), *(F.col(f"g.w{k}").alias(f"d{k}") for k in range(K)))
    # equal words behind equal hashes: every vote is verified
    same = (F.col("d0") == F.col("w0")) & (F.col("d1") == F.col("w1")) & (F.col("d2") == F.col("w2"))
    votes = rolled.join(table, "gram").where(same).select(
        "id", "key", "template", "label", "base", "strict", "size", "at", (F.col("pos") - F.col("at")).alias("diagonal")
    )
    of_doc = ["id", "key"]
    of_template = [*of_doc, "template", "label", "base", "strict", "size"]
    diagonals = votes.groupBy(*of_template, "diagonal").agg(F.collect_set("at").alias("hits"))

    order = Window.partitionBy("id", "key", "template").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(order)
    # base phrases are exact: each of their diagonals stands alone
    starts = F.when(F.col("base") | step.isNull() | (step > t.max_shift), 1).otherwise(0)
    islands = diagonals.withColumn("starts", starts).withColumn("island", F.sum("starts").over(order))
    spans = islands.select(*of_template, "island", "diagonal", F.explode("hits").alias("at")).groupBy(*of_template, "island").agg(
        F.min(F.col("diagonal") + F.col("at")).alias("first"),
        (F.max(F.col("diagonal") + F.col("at")) + K).alias("end"),
        F.collect_set("at").alias("hits"),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("hits", lambda p: F.sequence(p, p + (K - 1))))))
    spans = spans.withColumn("covered", covered).withColumn("cover", F.col("covered") / F.col("size"))
    exact = F.col("base") & (F.size("hits") == F.col("size") - (K - 1))
    near = ~F.col("base") & (F.col("cover") >= t.min_cover) & (F.col("end") - F.col("first") <= F.col("size") * t.max_stretch)
    kept = ["base", "label", "first", "cover"]
    verified = spans.where(exact).select(*of_doc, *kept).unionByName(_fittest(spans.where(near), t).select(*of_doc, *kept))

    listed = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    base_only = lambda c: F.when(F.col("base"), F.col(c))
    found = verified.groupBy(*of_doc).agg(
        F.sum(F.col("base").cast("long")).alias("n_base"),
        F.min(base_only("first")).cast("long").alias("first_word"),
        F.max(base_only("first")).cast("long").alias("last_word"),
        listed(base_only("label")).alias("base_labels"),
        listed("label").alias("labels"),
        F.max(F.when(F.col("base"), 1.0).otherwise(F.col("cover"))).alias("score"),
        F.sum((~F.col("base")).cast("long")).alias("n_spans"),
    )
    left = rows.select("id", "key", F.size("words").cast("long").alias("n_words"))
    joined = left.join(found.withColumnsRenamed({"id": "found_id", "key": "found_key"}), F.col("id").eqNullSafe(F.col("found_id")) & (F.col("key") == F.col("found_key")), "left")
    empty = {"n_base": 0, "base_labels": "", "labels": "", "score": 0.0, "n_spans": 0}
    return joined.select(
        F.col("id").alias(id_col),
        "n_words",
        *(F.coalesce(c, F.lit(empty[c])).alias(c) if c in empty else F.col(c) for c in found.columns if c not in of_doc),
    )


def oracle_sql(templates: Templates = Templates(), table: str = "documents") -> str:
    """The same scan as DuckDB SQL, for ``license_scan`` over ``table``."""
    t = templates
    quoted = ", ".join(
        f"({k}, '{label}', {base}, {strict}, {size}, {p}, '{a}', '{b}', '{c}')" for k, label, base, strict, size, p, a, b, c in t.grams()
    )
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SEPARATOR.replace('[', '[^', 1)}')"
    return f"""
WITH templates(template, label, base, strict, size, p, w0, w1, w2) AS (VALUES {quoted}),
cut AS (SELECT doc_id, row_number() OVER () AS r, {words} AS words FROM {table}),
places AS (SELECT r, words, unnest(range(1, len(words) - {K - 2})) AS i FROM cut),
votes AS (
  SELECT DISTINCT r, template, label, base, strict, size, p, i - 1 - p AS diagonal
  FROM places JOIN templates ON words[i] = w0 AND words[i + 1] = w1 AND words[i + 2] = w2),
diagonals AS (SELECT DISTINCT r, template, base, diagonal FROM votes),
cuts AS (
  SELECT *, CASE WHEN base THEN 1 WHEN diagonal - lag(diagonal) OVER w <= {t.max_shift} THEN 0 ELSE 1 END AS starts
  FROM diagonals WINDOW w AS (PARTITION BY r, template ORDER BY diagonal)),
islands AS (SELECT r, template, diagonal, sum(starts) OVER (PARTITION BY r, template ORDER BY diagonal) AS island FROM cuts),
counts AS (
  SELECT r, template, label, base, strict, size, island, min(diagonal + p) AS first, max(diagonal + p) + {K} AS last,
    count(DISTINCT p) AS grams, len(list_distinct(flatten(list([p, p + 1, p + 2])))) AS covered
  FROM votes JOIN islands USING (r, template, diagonal) GROUP BY r, template, label, base, strict, size, island),
spans AS (SELECT *, covered / size AS cover, greatest(last - first - covered, 0) + size - covered AS off FROM counts),
fitting AS (
  SELECT * FROM spans WHERE CASE WHEN base THEN grams = size - {K - 1} ELSE cover >= {t.min_cover} AND last - first <= size * {t.max_stretch} END),
verified AS (
  SELECT * FROM fitting a WHERE base OR NOT EXISTS (
    SELECT 1 FROM fitting b WHERE NOT b.base AND b.r = a.r AND b.label <> a.label
      AND least(a.last, b.last) - greatest(a.first, b.first) > least(a.last - a.first, b.last - b.first) * {t.min_overlap}
      AND (b.off, -b.covered, b.strict, b.template, b.first) < (a.off, -a.covered, a.strict, a.template, a.first))),
found AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
    max(CASE WHEN base THEN 1.0::DOUBLE ELSE cover END) AS score, count(*) FILTER (NOT base) AS n_spans
  FROM verified GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score, coalesce(n_spans, 0) AS n_spans
FROM cut LEFT JOIN found USING (r)"""
