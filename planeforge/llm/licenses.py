"""Operator 10: license scans by diagonal voting, on DataFrame functions only.

Every run of three words of every text is hashed and joined to the places where a template has the same three words (an
equality join on the hash, with the words themselves compared in the join, so a collision is no hit). A hit votes for its
diagonal, the offset of text place and template place. Diagonals at most ``NEAR`` apart, which inserted or left-out words
make of one occurrence, are merged; of a merged span every window of at most ``STRETCH`` times the template's length is
tried, and one of them must hold ``COVER`` of the template's runs: so a stray vote next to an occurrence never hides it.
Base phrases need every run on one diagonal.
``OP10_SQL`` has the same rule.

The templates are a fixed list, so their side of the join is broadcast, and its size is bounded whatever the texts are.
The texts are read once; what is shuffled is one narrow row a document and the hits, dealt by row, so no license, source
or phrase is a hot key.

Rows: every input row gives one output row, repeated and tied rows too; a null text is an empty one with no words; an
empty table gives an empty table. Only the id and text columns are read, so other columns and their names do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import column, documents, width

RUN = 3
NEAR = 3
COVER = 0.7
STRETCH = 1.5

# Characters that part words, and the phrases of the contract with their labels.
PARTS = "".join(chr(c) for c in range(128) if not (0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A))
PARTING = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# Well-known passages of public licenses, as their words.
PASSAGES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "you may not use this file except in compliance with the license": "apache-2",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "licensed under the gnu general public license version 3": "gpl-3",
    "licensed under the gnu general public license version 2": "gpl-2",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "this source code form is subject to the terms of the mozilla public license": "mpl-2",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "licensed under a creative commons attribution": "cc-by",
    "licensed under cc by sa": "cc-by-sa",
}


def template_runs() -> list[tuple[int, str, bool, int, int, str]]:
    """(template, label, base, runs of the template, place, words): every run of every template."""
    out = []
    for t, (text, label) in enumerate([*PHRASES.items(), *PASSAGES.items()]):
        words = text.split(" ")
        n = len(words) - RUN + 1
        out += [(t, label, t < len(PHRASES), n, i, " ".join(words[i : i + RUN])) for i in range(n)]
    return out


def words_of(text: Column) -> Column:
    """Words of the text with A-Z in lower case. The Kelvin sign, whose lower case is an ASCII letter, is no such letter."""
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("к")))
    bare = F.btrim(low, F.lit(PARTS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, PARTING))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    score is the largest share of a template's runs in a verified span, 0 if there is none.
    """
    spark = docs.sparkSession
    runs = spark.createDataFrame(template_runs(), "template int, label string, base boolean, runs int, at int, words string")
    runs = F.broadcast(runs.withColumn("hash", F.xxhash64("words")))
    texts = docs.select(F.monotonically_increasing_id().alias("row"), column(docs, id_col).cast("long").alias("doc_id"), words_of(column(docs, text_col).cast("string")).alias("all"))
    each = texts.select("row", "doc_id", F.size("all").alias("n_words"), "all", F.posexplode_outer("all").alias("pos", "w"))
    own = F.when(F.col("pos") + RUN <= F.col("n_words"), F.concat_ws(" ", "w", *[F.get("all", F.col("pos") + k) for k in range(1, RUN)]))
    each = each.select("row", "doc_id", "n_words", F.coalesce("pos", F.lit(0)).alias("pos"), own.alias("own")).withColumn("own_hash", F.xxhash64("own"))
    hits = each.join(runs, (F.col("own_hash") == F.col("hash")) & (F.col("own") == F.col("words")), "left")
    # Hits, and one row of each document without a hit at its first word.
    hits = hits.where(F.col("template").isNotNull() | (F.col("pos") == 0))
    hits = hits.select("row", "doc_id", "n_words", "template", "label", "base", "runs", "at", "pos", (F.col("pos") - F.col("at")).alias("diagonal"))
    hits = hits.repartition(width(spark), "row")

    key = ["row", "doc_id", "n_words", "template", "label", "base", "runs"]
    in_order = Window.partitionBy("row", "template").orderBy("diagonal", "pos")
    apart = F.col("diagonal") - F.lag("diagonal").over(in_order) > F.when(F.col("base"), 0).otherwise(NEAR)
    votes = hits.withColumn("fresh", F.coalesce(apart, F.lit(True)).cast("int"))
    votes = votes.withColumn("span", F.sum("fresh").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    # Places in parts of the longest span a template may have, so that one range holds for all (spans are under 100 words).
    longest = F.floor(STRETCH * F.col("runs"))
    votes = votes.withColumn("scaled", F.round(F.col("pos").cast("double") * 1_000_000 / longest).cast("long"))
    ahead = Window.partitionBy("row", "template", "span").orderBy("scaled").rangeBetween(0, 990_000)
    votes = votes.withColumn("inside", F.size(F.collect_set("at").over(ahead)))
    spans = votes.groupBy(*key, "span").agg(F.max("inside").alias("held"), F.min("pos").alias("first"))
    share = F.col("held") / F.col("runs")
    good = F.when(F.col("base"), share == 1).otherwise(share >= COVER)
    spans = spans.withColumn("good", F.coalesce(good, F.lit(False)))
    base = F.col("good") & F.col("base")
    out = spans.groupBy("row", "doc_id", "n_words").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("base_labels"),
        F.collect_set(F.when(F.col("good"), F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(F.col("good"), share)), F.lit(0.0)).alias("score"),
    )
    joined = {c: F.array_join(F.array_sort(c), ",").alias(c) for c in ("base_labels", "labels")}
    return out.select("doc_id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word", *joined.values(), "score")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


_RUNS = ", ".join(f"({t}, '{label}', {str(base).lower()}, {n}, {at}, '{words}')" for t, label, base, n, at, words in template_runs())

OP10_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), t AS (
  SELECT * FROM (VALUES {_RUNS}) AS t(template, label, base, runs, place, words)
), g AS (
  SELECT r, i - 1 AS pos, array_to_string(w[i:i + {RUN - 1}], ' ') AS words
  FROM (SELECT r, w, unnest(range(1, len(w) - {RUN - 2})) AS i FROM d WHERE len(w) >= {RUN})
), v AS (
  SELECT r, template, label, base, runs, place, pos, pos - place AS diagonal FROM g JOIN t USING (words)
), n AS (
  SELECT *, sum(fresh) OVER (PARTITION BY r, template ORDER BY diagonal, pos) AS span
  FROM (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal, pos)
                            <= CASE WHEN base THEN 0 ELSE {NEAR} END THEN 0 ELSE 1 END AS fresh FROM v)
), x AS (
  SELECT *, count(DISTINCT place) OVER (PARTITION BY r, template, span ORDER BY pos
                                        RANGE BETWEEN CURRENT ROW AND floor({STRETCH} * runs)::BIGINT - 1 FOLLOWING) AS inside FROM n
), s AS (
  SELECT r, label, base, runs, max(inside) AS held, min(pos) AS first FROM x GROUP BY r, template, label, base, runs, span
), k AS (
  SELECT *, held / runs AS share FROM s WHERE CASE WHEN base THEN held = runs ELSE held / runs >= {COVER} END
), o AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word,
         string_agg(DISTINCT CASE WHEN base THEN label END, ',' ORDER BY CASE WHEN base THEN label END) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM k GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN o ON d.r = o.r
"""
