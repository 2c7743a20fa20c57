"""License scans by diagonal voting, with DataFrame operations alone.

Every `K` consecutive words of a text are hashed and joined with the positions of the same words in the
license templates. A hit at word p of the text and word q of a template is a vote for the diagonal p - q:
a notice that starts at word d puts its votes on diagonal d, and a word too many or too few inside of it
moves the rest to a neighbouring one. Votes of diagonals at most `drift` apart are merged, and the merged
span is verified: hits count only where the words themselves agree, the share of the template's words that lie in
a hit has to reach `share`, and its `core`, the words that tell it from other licenses, has to be hit.

Phrases are templates that have to stand word by word: all votes on one diagonal. Their places and labels
are kept whatever the templates find.

The templates are a literal list of the caller, so their side of the join is small at any size of the
corpus. Only hits and one row per text meet in the shuffle, not the texts. A text is read once and by one
task, so it may have a row number that only this run knows. Votes of one text and template meet in one task;
they are at most the text's words times the template's, however often others repeat them.

Null and empty texts have no words and no labels. A text with fewer than `K` words has no hits. Repeated
rows are scanned each, a null id is kept. No rows: no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import read

K = 3
DRIFT = 3
SHARE = 0.8

#: (label, phrase) pairs that label a text wherever they stand.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

#: (label, notice, core): usual wordings of public license notices. Fixed values.
TEMPLATES = (
    ("mit", "released under the mit license", "the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "free of charge"),
    ("apache-2", "licensed under the apache license version 2 0", "the apache license"),
    ("apache-2", "you may not use this file except in compliance with the license", "use this file except"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike"),
    ("gpl", "this work is licensed under the gnu general public license", "gnu general public license"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public"),
    ("agpl", "licensed under the gnu affero general public license", "gnu affero general public"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(_WORD), F.lit(0))


def template_rows(phrases=PHRASES, templates=TEMPLATES) -> list[tuple]:
    """(template, label, exact, words, core, at, gram) for each `K` words of each template; core lists places."""
    out = []
    for number, (label, text, core) in enumerate([(label, text, "") for label, text in phrases] + list(templates)):
        words, inner = text.split(), core.split()
        grams = [words[i : i + K] for i in range(len(words) - K + 1)]
        starts = [i for i in range(len(words)) if words[i : i + len(inner)] == inner]
        if not grams or number >= len(phrases) and (len(inner) < K or not starts):
            raise ValueError(f"a template has {K} words or more, and a core in it: {text!r}")
        must = list(range(starts[0], starts[0] + len(inner) - K + 1)) if inner else []
        out += [(number, label, number < len(phrases), len(words), must, i, g) for i, g in enumerate(grams)]
    return out


def license_hits(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """(_row, doc_id, n_words, template, label, exact, words, core, diagonal, hits): the places in the
    template that were hit, by diagonal, and one row per text without a template."""
    spark = docs.sparkSession
    schema = "template int, label string, exact boolean, words int, core array<int>, at int, own array<string>"
    known = spark.createDataFrame(template_rows(phrases, templates), schema).withColumn("hash", F.xxhash64("own"))
    texts = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(doc_id).alias("doc_id"), words_of(F.col(text)).alias("w"))
    last = F.size("w") - K
    # the empty gram ahead of all others keeps a row of each text
    grams = F.when(last < 0, F.array(F.array().cast("array<string>"))).otherwise(
        F.concat(F.array(F.array().cast("array<string>")), F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.slice("w", i, K)))
    )
    rolled = texts.select("_row", "doc_id", F.size("w").cast("long").alias("n_words"), F.posexplode(grams).alias("place", "gram"))
    joined = rolled.withColumn("hash", F.xxhash64("gram")).join(F.broadcast(known), "hash", "left")
    hit = F.col("own") == F.col("gram")  # the words themselves, whatever the hash says
    votes = joined.filter(F.coalesce(hit, F.lit(False)) | (F.col("place") == 0)).withColumn("diagonal", F.col("place") - 1 - F.col("at"))
    keys = ["_row", "doc_id", "n_words", "template", "label", "exact", "words", "core", "diagonal"]
    return votes.repartition("_row").groupBy(keys).agg(F.sort_array(F.collect_list("at")).alias("hits"))


def license_spans(hits: DataFrame, *, drift: int = DRIFT, share: float = SHARE) -> DataFrame:
    """`hits` with the merged votes around each diagonal: `first` and `last` word, `score`, and whether the
    span is `verified`. A phrase's score is 1 where it stands and 0 else."""
    near = Window.partitionBy("_row", "template").orderBy("diagonal").rangeBetween(-drift, drift)
    span = F.flatten(F.collect_list(F.transform("hits", lambda q: F.struct(q.alias("at"), (F.col("diagonal") + q).alias("place")))).over(near))
    merged = hits.withColumn("merged", span)
    at = F.array_distinct(F.transform("merged", lambda h: h["at"]))
    covered = F.size(F.array_distinct(F.flatten(F.transform(at, lambda q: F.sequence(q, q + K - 1)))))
    whole = F.size("hits") == F.col("words") - K + 1
    score = F.when(F.col("exact"), whole.cast("double")).otherwise(covered / F.col("words"))
    return merged.select(
        *hits.columns,
        F.array_min(F.transform("merged", lambda h: h["place"])).alias("first"),
        (F.array_max(F.transform("merged", lambda h: h["place"])) + K - 1).alias("last"),
        score.alias("score"),
        F.when(F.col("exact"), whole).otherwise((score >= share) & (F.size(F.array_except("core", at)) == 0)).alias("verified"),
    )


def license_labels(docs: DataFrame, *, drift: int = DRIFT, share: float = SHARE, **options) -> DataFrame:
    """One row per text: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and
    spans (label, first, last, score) of the verified templates, at the best diagonal of its neighbourhood."""
    spans = license_spans(license_hits(docs, **options), drift=drift, share=share)
    near = Window.partitionBy("_row", "template").orderBy("diagonal").rangeBetween(-drift, drift)
    # of neighbouring diagonals with one span, the best is named: most of its template, most own votes, the first
    rank = F.struct("score", F.size("hits").alias("votes"), (-F.col("diagonal")).alias("early"))
    best = spans.withColumn("rank", rank).withColumn("peak", F.col("rank") == F.max("rank").over(near))
    base, found = F.col("exact") & F.col("verified"), F.col("verified")
    joined = lambda when: F.array_join(F.sort_array(F.collect_set(F.when(when, F.col("label")))), ",")
    span = F.struct("first", "last", "label", "score")
    return (
        best.groupBy("_row", "doc_id", "n_words")
        .agg(
            F.count(F.when(base, 1)).alias("n_base"),
            F.min(F.when(base, F.col("diagonal").cast("long"))).alias("first_word"),
            F.max(F.when(base, F.col("diagonal").cast("long"))).alias("last_word"),
            joined(base).alias("base_labels"),
            joined(found).alias("labels"),
            F.coalesce(F.max("score"), F.lit(0.0)).alias("score"),
            F.sort_array(F.collect_list(F.when(found & ~F.col("exact") & F.col("peak"), span))).alias("spans"),
        )
        .drop("_row")
    )


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_labels(read(spark, sf_dir, "documents")).drop("spans")


def _sql_templates() -> str:
    rows = template_rows()
    return ", ".join(f"({t}, '{label}', {exact}, {words}, {core}::INT[], {at}, {gram})" for t, label, exact, words, core, at, gram in rows)


SQL = {
    "op12_license_scan": rf"""
WITH known(template, label, exact, words, core, q, gram) AS (VALUES {_sql_templates()}),
texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), grams AS (
  SELECT r, place, w[place + 1 : place + {K}] AS gram FROM (SELECT r, w, unnest(range(len(w) - {K - 1})) AS place FROM texts)
), hits AS (
  SELECT r, template, label, exact, words, core, place - q AS diagonal, list(q) AS ats, count(*) AS votes
  FROM grams JOIN known USING (gram) GROUP BY ALL
), merged AS (
  SELECT a.r, a.template, a.label, a.exact, a.words, a.core, a.diagonal, a.votes, list_distinct(flatten(list(b.ats))) AS ats
  FROM hits a JOIN hits b ON a.r = b.r AND a.template = b.template AND abs(a.diagonal - b.diagonal) <= {DRIFT} GROUP BY ALL
), scored AS (
  SELECT *, CASE WHEN exact THEN (votes = words - {K - 1})::INT::DOUBLE
    ELSE len(list_distinct(flatten([{", ".join(f"list_transform(ats, lambda x: x + {i})" for i in range(K))}]))) / words END AS s FROM merged
), judged AS (
  SELECT *, CASE WHEN exact THEN s = 1 ELSE s >= {SHARE} AND list_has_all(ats, core) END AS verified FROM scored
)
SELECT doc_id, len(w)::BIGINT AS n_words, count(j.r) FILTER (exact AND verified) AS n_base,
       min(diagonal) FILTER (exact AND verified)::BIGINT AS first_word, max(diagonal) FILTER (exact AND verified)::BIGINT AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact AND verified), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (verified), '') AS labels, coalesce(max(s), 0)::DOUBLE AS score
FROM texts LEFT JOIN judged j USING (r) GROUP BY r, doc_id, w
""",
}
