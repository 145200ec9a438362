"""License scans by diagonal voting.

Templates are word sequences with a label: short phrases, and the notices that
licenses ask to be put on a work.  For every text:

1. All rolling k-grams of its words (k = 2 for phrases, 4 for notices) are
   hashed and joined with the hashes of the templates' k-grams.  The words of a
   gram are compared too, so equal hashes of other words never count.
2. A hit votes for the diagonal (place in the text - place in the template);
   votes are aggregated by text, template and diagonal.
3. Neighbouring diagonals of one template, as words put in or left out make
   them, are merged (phrases must stand consecutively: they are not merged).
4. A merged span is verified: the share of words that the grams cover, of the
   template or the span, whichever is longer, must reach the template's limit.

The template table is fixed and small, and is the only broadcast.  Every text
is exploded where it is scanned; what is shuffled are hits (and one row per
text).  Every text also holds the empty gram once, which hits the empty
template: so texts without any license come out of the same aggregation.

Defined results
* null or empty text, or one without words: 0 words, no places, empty labels,
  null first and last word, score 0.
* rows of equal id and equal text (null ids too) are counted once and put out
  as often as they came; rows of one id with different texts stay apart.
* a text fits a row: all grams of one text are one array, whatever its length.
* ties: equal scores need no order, only the largest is returned.
* only the id is carried over: other columns of the input, whatever their
  names, are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import read

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases that name a license, and the notices that licenses prescribe.
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
NOTICES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software, and to permit persons to whom the Software is furnished to do so"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
               "compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
            "option) any later version."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
            "not distributed with this file, You can obtain one at"),
    ("cc-by", "licensed under CC BY 4.0"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0"),
    ("cc-by-nd", "licensed under CC BY-ND 4.0"),
]
PHRASE_GRAM, NOTICE_GRAM = 2, 4
# Share of words of a notice that a span must hold.
LIMIT = 0.8
# Diagonals merge up to this distance, or half the template's length if that is less.
SLACK = 10


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


def templates(phrases=None, notices=None) -> list[tuple[int, str, list[str], int, float, int, bool]]:
    """(number, label, words, gram length, least share, distance of merged diagonals, is a phrase)."""
    out = [(label, words_of(text), PHRASE_GRAM, 1.0, 0, True) for label, text in phrases or PHRASES]
    out += [(label, words_of(text), NOTICE_GRAM, LIMIT, min(SLACK, len(words_of(text)) // 2), False)
            for label, text in notices or NOTICES]
    if any(len(words) < k for _, words, k, *_ in out):
        raise ValueError("a template needs as many words as its grams")
    return [(i, *t) for i, t in enumerate(out)]


def gram_rows(known) -> list[tuple[int, int, list[str]]]:
    """(template, place, gram) of all templates; the empty gram is template -1."""
    return [(-1, 0, [])] + [(i, p, words[p:p + k]) for i, _, words, k, *_ in known for p in range(len(words) - k + 1)]


def gram_hash(words: Column, start: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(words, start + j) for j in range(k)])


def gram_table(spark: SparkSession, known) -> DataFrame:
    rows = spark.createDataFrame(gram_rows(known), "template int, t_place int, gram array<string>")
    k = F.size("gram")
    hashes = F.lit(None).cast("long")
    for n in (0, PHRASE_GRAM, NOTICE_GRAM):
        hashes = F.coalesce(F.when(k == n, gram_hash(F.col("gram"), F.lit(0), n)), hashes)
    return rows.withColumn("t_hash", hashes)


def hits(df: DataFrame, known, doc_id: str, text: str) -> DataFrame:
    """One row per (text, k-gram of it, equal k-gram of a template)."""
    t = F.coalesce(F.col(text), F.lit(""))
    docs = df.select(
        F.col(doc_id).alias("id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"),
        F.regexp_extract_all(F.translate(t, UPPER, LOWER), F.lit(f"({WORD})"), F.lit(1)).alias("w"))
    n = F.size("w")

    def grams(k: int) -> Column:
        starts = F.when(n >= k, F.sequence(F.lit(0), n - k)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(i.alias("place"), gram_hash(F.col("w"), i, k).alias("hash")))
    empty = F.array(F.struct(F.lit(0).alias("place"), gram_hash(F.col("w"), F.lit(0), 0).alias("hash")))
    docs = docs.withColumn("g", F.concat(empty, grams(PHRASE_GRAM), grams(NOTICE_GRAM)))
    docs = docs.select("id", "h1", "h2", "w", F.size("w").cast("long").alias("n_words"), F.explode_outer("g").alias("g"))  # outer: no filter is inferred that would build the grams twice
    docs = docs.select("id", "h1", "h2", "w", "n_words", F.col("g.place").alias("place"), F.col("g.hash").alias("hash"))
    table = F.broadcast(gram_table(df.sparkSession, known))
    same = (F.col("hash") == F.col("t_hash")) & (F.slice("w", F.col("place") + 1, F.size("gram")) == F.col("gram"))
    return docs.join(table, same).select(
        "id", "h1", "h2", "n_words", "template", "t_place", (F.col("place") - F.col("t_place")).alias("diagonal"))


KEY = ["id", "h1", "h2", "n_words"]


def spans(found: DataFrame, known, spark: SparkSession) -> DataFrame:
    """Merged and verified spans (text, template, start, share); one row per text of template -1 holds its copies."""
    facts = F.broadcast(spark.createDataFrame(
        [(-1, 0, 0, 0.0, 0)] + [(i, len(w), k, limit, slack) for i, _, w, k, limit, slack, _ in known],
        "template int, t_length int, k int, limit double, slack int"))
    # The sets hold places of a template, so they are as small as it is.
    votes = found.groupBy(*KEY, "template", "diagonal").agg(
        F.collect_set("t_place").alias("places"), F.count("*").alias("n_rows"))
    votes = votes.join(facts, "template")
    line = Window.partitionBy(*KEY, "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(line) > F.col("slack")
    votes = votes.withColumn("new", F.coalesce(apart, F.lit(True)).cast("long"))
    votes = votes.withColumn("span", F.sum("new").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    merged = votes.withColumn("t_place", F.explode("places")).groupBy(
        *KEY, "template", "span", "t_length", "k", "limit").agg(
        F.array_sort(F.collect_set("t_place")).alias("places"),
        F.min(F.col("diagonal") + F.col("t_place")).alias("start"),
        F.max(F.col("diagonal") + F.col("t_place") + F.col("k")).alias("end"),
        F.max("n_rows").alias("n_rows"))
    covered = F.aggregate(
        F.transform("places", lambda p, i: F.least("k", F.coalesce(F.get("places", i + 1) - p, F.col("k")))),
        F.lit(0), lambda a, x: a + x)
    length = F.greatest(F.col("t_length"), F.col("end") - F.col("start"))
    merged = merged.withColumn("share", F.when(F.col("template") >= 0, covered / length).otherwise(0.0))
    return merged.filter(F.col("share") >= F.col("limit"))


def scan_licenses(df: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases=None, notices=None) -> DataFrame:
    """One row per row of ``df``: its id as ``doc_id``, n_words, n_base, first_word, last_word, base_labels, labels,
    score (the largest share of a template that was found) and ``spans`` (label, start, length, share, phrase)."""
    spark = df.sparkSession
    known = templates(phrases, notices)
    names = F.broadcast(spark.createDataFrame([(-1, None, False)] + [(t[0], t[1], t[-1]) for t in known],
                                              "template int, label string, phrase boolean"))
    found = spans(hits(df, known, doc_id, text), known, spark).join(names, "template")
    start = F.when(F.col("phrase"), F.col("start")).cast("long")

    def joined(which: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    out = found.groupBy(*KEY).agg(
        F.max(F.when(F.col("template") < 0, F.col("n_rows"))).alias("n_rows"),
        F.count(start).alias("n_base"), F.min(start).alias("first_word"), F.max(start).alias("last_word"),
        joined(F.col("phrase")).alias("base_labels"), joined(F.lit(True)).alias("labels"),
        F.max("share").alias("score"),
        F.array_sort(F.collect_list(F.when(F.col("template") >= 0, F.struct(
            F.col("start").cast("long").alias("start"), (F.col("end") - F.col("start")).cast("long").alias("length"), "label", "share",
            "phrase")))).alias("spans"))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows")))
    return out.withColumn("__copy", copies).select(
        F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")


def op12_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document."""
    return scan_licenses(read(spark, sf_dir, "documents", "doc_id", "text")).drop("spans")


def _oracle_sql() -> str:
    known = templates()
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    rows = ", ".join(f"({i}, '{label}', {quoted(w)}, {k}, {limit}, {slack}, {phrase})"
                     for i, label, w, k, limit, slack, phrase in known)
    return rf"""
WITH known(template, label, tw, k, least, slack, phrase) AS (VALUES {rows}),
grams AS (SELECT template, k, p, array_to_string(tw[p + 1:p + k], ' ') AS gram
  FROM (SELECT *, unnest(range(len(tw) - k + 1)) AS p FROM known)),
docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}'), []) AS w FROM documents),
places AS (
  SELECT r, k, i, array_to_string(w[i + 1:i + k], ' ') AS gram
  FROM (SELECT r, w, k, unnest(range(len(w) - k + 1)) AS i FROM docs, (VALUES ({PHRASE_GRAM}), ({NOTICE_GRAM})) ks(k))),
hits AS (SELECT r, template, places.k, p, i, i - p AS diagonal FROM places JOIN grams USING (k, gram)),
lines AS (SELECT DISTINCT r, template, diagonal FROM hits),
gaps AS (
  SELECT lines.*, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, lines.template ORDER BY diagonal) <= slack
    THEN 0 ELSE 1 END AS new FROM lines JOIN known ON lines.template = known.template),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY r, template ORDER BY diagonal) AS span FROM gaps),
ends AS (
  SELECT r, template, span, min(i) AS s, max(i + k) AS e FROM hits JOIN numbered USING (r, template, diagonal) GROUP BY ALL),
cover AS (
  SELECT r, template, span, count(DISTINCT x) AS n
  FROM (SELECT r, template, span, unnest(range(p, p + k)) AS x FROM hits JOIN numbered USING (r, template, diagonal)) GROUP BY ALL),
found AS (
  SELECT r, s, label, phrase, n / greatest(len(tw), e - s) AS share
  FROM ends JOIN cover USING (r, template, span) JOIN known USING (template) WHERE n / greatest(len(tw), e - s) >= least),
summed AS (
  SELECT r, count(*) FILTER (phrase) AS n_base, min(s) FILTER (phrase) AS first_word, max(s) FILTER (phrase) AS last_word,
    coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase), '') AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM found GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM docs LEFT JOIN summed ON summed.r = docs.r
"""


ORACLE_SQL = _oracle_sql()
