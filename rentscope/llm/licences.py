"""Licence scan by a positional index of rare words (operator 12).

Words are runs of letters, digits and all non-ASCII characters; A-Z is
lower-cased.  NOTICES are short licence notices, each with the phrases it must
hold; BASE are phrases that name a licence by themselves.  One pass over the
texts keeps the places of the words that occur in any of them (the licence
words); everything later works on these.

How many documents hold each licence word gives its weight (the logarithm of
the inverse share, in thousandths).  The index holds, for every notice, the
places of its RARE words of the highest weight, and for every phrase the place
of its rarest word.  A file's words are looked up there; a hit at word i of the
file and p of a notice votes for the notice to begin at i - p.  Votes of a notice
that lie within DRIFT of each other are one candidate (words may have been put
in or left out), whose score is the share of the weight of the notice's rare
words that it found.  A candidate with LEAST or more is reported if every
mandatory phrase stands in its reach.  Phrases themselves are found by their
rarest word, and all their words are then compared place by place; every place
of a base phrase counts.

Defined results: null text is empty (no words, no labels, score 0); a phrase
found as a base phrase scores 1; repeated rows each give a row and count as
documents of their own in the weights; an empty table gives no rows; other
columns are not read.  Only the notices and phrases (a bounded table) are
broadcast.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rentscope.llm.tables import kept, table, text_or_empty

RARE, DRIFT, LEAST = 8, 8, 0.6
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Phrases that name a licence, and licence notices (label, notice, mandatory phrases)
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
NOTICES = [
    ("mit", "Released under the MIT License", ["under the mit license"]),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
     ["permission is hereby granted free of charge"]),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                 "compliance with the License.", ["apache license version 2"]),
    ("apache-2", "Licensed under the Apache License, Version 2.0", ["apache license version 2"]),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3",
     ["gnu general public license version 3"]),
    ("gpl-3", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
              "the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
     ["gnu general public license", "version 3"]),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2",
     ["gnu general public license version 2"]),
    ("gpl-2", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
              "the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
     ["gnu general public license", "version 2"]),
    ("lgpl-3", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
               "published by the Free Software Foundation, either version 3 of the License",
     ["gnu lesser general public license", "version 3"]),
    ("agpl-3", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
               "published by the Free Software Foundation, either version 3 of the License",
     ["gnu affero general public license", "version 3"]),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                     "promote products derived from this software without specific prior written permission",
     ["neither the name of", "endorse or promote products derived from this software"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies",
     ["distribute this software for any purpose with or without fee"]),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
              "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
     ["mozilla public license v 2"]),
    ("unlicense", "This is free and unencumbered software released into the public domain",
     ["unencumbered software released into the public domain"]),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License",
     ["creative commons attribution 4"]),
    ("cc-by", "Licensed under CC BY 4.0", ["cc by 4"]),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
     ["creative commons attribution sharealike"]),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", ["cc by sa"]),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
     ["creative commons attribution noncommercial 4"]),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ["cc by nc 4"]),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0", ["cc by nd"]),
    ("cc0", "released under CC0 1.0 Universal Public Domain Dedication", ["cc0 1 0 universal"]),
]


def words_of(text: str) -> list[str]:
    """The words of a notice or phrase (ASCII)."""
    return [w for w in re.split(NO_WORD, text.lower()) if w]


class Index:
    """What is looked up: rows (item, word, place, size) of phrases and notices."""

    def __init__(self, base: dict[str, str] = BASE, notices: list[tuple[str, str, list[str]]] = NOTICES):
        self.base, self.notices = base, notices
        self.phrases = sorted({*base, *(p for _, _, must in notices for p in must)})
        self.phrase_words = [(p, w, k, len(words_of(p))) for p in self.phrases for k, w in enumerate(words_of(p))]
        self.notice_words = [(n, w, k, len(words_of(text))) for n, (_, text, _) in enumerate(notices)
                             for k, w in enumerate(words_of(text))]
        self.must = [(n, p) for n, (*_, must) in enumerate(notices) for p in must]
        self.vocabulary = sorted({w for _, w, *_ in [*self.phrase_words, *self.notice_words]})


def rows_of(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small table of fixed rows."""
    return spark.range(1).select(F.explode(F.array(*(
        F.struct(*(F.lit(x).alias(n) for x, n in zip(r, names))) for r in rows))).alias("x")).select("x.*")


def licence_words(df: DataFrame, index: Index, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(row, doc_id, n_words, found): every row's licence words with their
    places, written."""
    lower = F.translate(text_or_empty(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"),
                     F.filter(F.split(lower, NO_WORD), lambda w: w != "").alias("words"))
    return kept(rows.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), F.filter(
        F.transform("words", lambda w, i: F.struct(i.cast("long").alias("i"), w.alias("w"))),
        lambda x: x["w"].isin(index.vocabulary)).alias("found")), "licence-words")


def rare_words(parts: DataFrame, index: Index) -> DataFrame:
    """(w, phrase, notice, p, size, weight, total): the positional index,
    written; no more rows than the phrases and notices have words."""
    spark = parts.sparkSession
    seen = (parts.select(F.explode(F.array_distinct(F.transform("found", lambda x: x["w"]))).alias("w"))
            .groupBy("w").agg(F.count("*").alias("df")))
    weights = kept(rows_of(spark, [(w,) for w in index.vocabulary], ["w"]).join(seen, "w", "left").select("w", (F.floor(
        1000 * F.ln((F.lit(parts.count()) + 1) / (F.coalesce("df", F.lit(0)) + 1))) + 1).alias("weight")), "word-weights")
    by_weight = Window.partitionBy("phrase").orderBy(F.desc("weight"), "p")
    phrases = (rows_of(spark, index.phrase_words, ["phrase", "w", "p", "size"]).join(weights, "w")
               .withColumn("nth", F.row_number().over(by_weight)).filter("nth = 1")
               .select("w", "phrase", F.lit(None).cast("int").alias("notice"), "p", "size", "weight",
                       F.lit(0).cast("long").alias("total")))
    notices = (rows_of(spark, index.notice_words, ["notice", "w", "p", "size"]).join(weights, "w")
               .withColumn("first", F.min("p").over(Window.partitionBy("notice", "w")))
               .withColumn("nth", F.dense_rank().over(Window.partitionBy("notice").orderBy(F.desc("weight"), "first")))
               .filter(F.col("nth") <= RARE)
               .withColumn("total", F.sum("weight").over(Window.partitionBy("notice")))
               .select("w", F.lit(None).cast("string").alias("phrase"), "notice", "p", "size", "weight", "total"))
    return kept(phrases.unionByName(notices), "rare-words")


def places(parts: DataFrame, hits: DataFrame, index: Index) -> DataFrame:
    """(row, phrase, start) of every place of every phrase, written."""
    spark = parts.sparkSession
    begun = kept(hits.filter("phrase IS NOT NULL AND i >= p").select("row", "phrase", "size", (F.col("i") - F.col("p")).alias("start")),
                 "phrase-starts")
    own = (parts.join(begun.select("row").distinct(), "row", "left_semi")
           .select("row", F.explode("found").alias("x")).select("row", "x.i", "x.w"))
    # every word of the phrase at its place
    wanted = begun.join(F.broadcast(rows_of(spark, index.phrase_words, ["phrase", "w", "k", "n"])), "phrase").select(
        "row", "phrase", "size", "start", "w", (F.col("start") + F.col("k")).alias("i"))
    return kept(wanted.join(own, ["row", "i", "w"]).groupBy("row", "phrase", "size", "start").agg(F.count("*").alias("n"))
                .filter("n = size").select("row", "phrase", "start"), "phrase-places")


def candidates(hits: DataFrame) -> DataFrame:
    """(row, notice, group, begin, end, score): votes that lie together."""
    votes = hits.filter("notice IS NOT NULL").withColumn("at", F.col("i") - F.col("p"))
    w = Window.partitionBy("row", "notice").orderBy("at", "p")
    votes = votes.withColumn("new", F.coalesce((F.col("at") - F.lag("at").over(w) > DRIFT).cast("int"), F.lit(1)))
    votes = votes.withColumn("group", F.sum("new").over(w))
    once = votes.groupBy("row", "notice", "group", "p").agg(
        F.max("weight").alias("weight"), F.max("total").alias("total"), F.max("size").alias("size"),
        F.min("at").alias("begin"), F.max("at").alias("last"))
    return (once.groupBy("row", "notice", "group").agg(
        (F.sum("weight") / F.max("total")).alias("score"), F.min("begin").alias("begin"),
        (F.max("last") + F.max("size")).alias("end")).filter(F.col("score") >= LEAST))


def verified(found: DataFrame, phrases: DataFrame, index: Index) -> DataFrame:
    """The candidates in whose reach every mandatory phrase begins, with their label."""
    spark = found.sparkSession
    must = found.join(F.broadcast(rows_of(spark, index.must, ["notice", "phrase"])), "notice").select(
        "row", "phrase", (F.col("begin") - DRIFT).alias("at"), F.lit(None).cast("long").alias("start"),
        F.struct("notice", "group", "begin", "end", "score").alias("of"))
    both = must.unionByName(phrases.select("row", "phrase", F.col("start").alias("at"), "start",
                                           F.lit(None).cast(must.schema["of"].dataType).alias("of")))
    # the first place of the phrase from where the reach begins
    following = Window.partitionBy("row", "phrase").orderBy("at").rangeBetween(0, Window.unboundedFollowing)
    labels = rows_of(spark, [(n, label) for n, (label, *_) in enumerate(index.notices)], ["notice", "label"])
    return (both.withColumn("next", F.min("start").over(following)).filter("of IS NOT NULL")
            .groupBy("row", "of").agg(F.every(F.coalesce(F.col("next") <= F.col("of.end") + DRIFT, F.lit(False))).alias("all"))
            .filter("all").select("row", "of.*").join(F.broadcast(labels), "notice"))


def scan(df: DataFrame, text: str = "text", key: str = "doc_id",
         index: Index | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(row, doc_id, n_words, found) of every row; (row, phrase, start) of every
    phrase; (row, notice, label, begin, end, score) of every notice."""
    index = index or Index()
    parts = licence_words(df, index, text, key)
    rare = rare_words(parts, index)
    hits = kept(parts.select("row", F.explode("found").alias("x")).select("row", "x.i", "x.w")
                .join(F.broadcast(rare), "w"), "licence-hits")
    phrases = places(parts, hits, index)
    return parts, phrases, kept(verified(candidates(hits), phrases, index), "notices")


def labelled(parts: DataFrame, phrases: DataFrame, notices: DataFrame, base: dict[str, str] = BASE) -> DataFrame:
    """Per row: base places, labels of both kinds, score."""
    spark = parts.sparkSession

    def joined(c: Column) -> Column:
        return F.array_join(F.sort_array(F.array_distinct(c)), ",")
    names = rows_of(spark, list(base.items()), ["phrase", "label"])
    of_base = phrases.join(F.broadcast(names), "phrase").groupBy("row").agg(
        F.count("*").alias("n_base"), F.min("start").alias("first_word"), F.max("start").alias("last_word"),
        F.collect_set("label").alias("base"))
    of_method = notices.groupBy("row").agg(F.collect_set("label").alias("own"), F.max("score").alias("best"))
    none = F.array().cast("array<string>")
    both = F.concat(F.coalesce("base", none), F.coalesce("own", none))
    return parts.select("row", "doc_id", "n_words").join(of_base, "row", "left").join(of_method, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        joined(F.coalesce("base", none)).alias("base_labels"), joined(both).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(*scan(table(spark, sf_dir, "documents")))


def oracle() -> str:
    """The query in DuckDB's SQL."""
    index = Index()

    def values(rows: list[tuple]) -> str:
        return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)
    return f"""
WITH phrase_words(phrase, w, p, size) AS (VALUES {values(index.phrase_words)}),
notice_words(notice, w, p, size) AS (VALUES {values(index.notice_words)}),
must(notice, phrase) AS (VALUES {values(index.must)}),
label_of(notice, label) AS (VALUES {values([(n, x) for n, (x, *_) in enumerate(index.notices)])}),
base_of(phrase, label) AS (VALUES {values(list(index.base.items()))}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
occ AS (SELECT r, i - 1 AS i, w FROM (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d)
        WHERE w IN (SELECT w FROM phrase_words UNION SELECT w FROM notice_words)),
vocabulary AS (SELECT w FROM phrase_words UNION SELECT w FROM notice_words),
weight AS (SELECT w, floor(1000 * ln(((SELECT count(*) FROM d) + 1) / (count(DISTINCT r) + 1)))::BIGINT + 1 AS weight
           FROM vocabulary LEFT JOIN occ USING (w) GROUP BY w),
places AS (SELECT r, phrase, start FROM (SELECT r, phrase, i - p AS start, size FROM occ JOIN phrase_words USING (w))
           GROUP BY r, phrase, start, size HAVING count(*) = size),
ranked AS (SELECT *, min(p) OVER (PARTITION BY notice, w) AS f FROM notice_words JOIN weight USING (w)),
rare AS (SELECT *, sum(weight) OVER (PARTITION BY notice) AS total FROM (SELECT * FROM ranked
         QUALIFY dense_rank() OVER (PARTITION BY notice ORDER BY weight DESC, f) <= {RARE})),
votes AS (SELECT r, notice, p, size, weight, total, i - p AS pos FROM occ JOIN rare USING (w)),
steps AS (SELECT *, coalesce(pos - lag(pos) OVER (PARTITION BY r, notice ORDER BY pos, p) > {DRIFT}, true)::INT AS new FROM votes),
grouped AS (SELECT *, sum(new) OVER (PARTITION BY r, notice ORDER BY pos, p ROWS UNBOUNDED PRECEDING) AS g FROM steps),
cand AS (SELECT r, notice, g, sum(weight)::DOUBLE / max(total) AS score, min(b) AS b, max(e) + max(size) AS e FROM (
         SELECT r, notice, g, p, size, weight, total, min(pos) AS b, max(pos) AS e FROM grouped GROUP BY ALL)
         GROUP BY r, notice, g HAVING score >= {LEAST!r}::DOUBLE),
missing AS (SELECT DISTINCT r, notice, g FROM cand JOIN must USING (notice) WHERE NOT EXISTS (
            SELECT 1 FROM places x WHERE x.r = cand.r AND x.phrase = must.phrase
            AND x.start BETWEEN cand.b - {DRIFT} AND cand.e + {DRIFT})),
own AS (SELECT r, label, score FROM cand JOIN label_of USING (notice) ANTI JOIN missing USING (r, notice, g)),
own_of AS (SELECT r, list(DISTINCT label) AS own, max(score) AS best FROM own GROUP BY r),
base AS (SELECT r, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, list(DISTINCT label) AS base
         FROM places JOIN base_of USING (phrase) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(own, [])))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN own_of USING (r)"""
