"""Operator 3: quality rules with adaptive thresholds from mergeable quantile sketches, on DataFrame functions only.

A sketch is a histogram over buckets of bounded relative width: whole numbers below 64 are buckets of their own, larger
ones share a bucket with numbers of the same first six binary digits. Adding counts merges sketches, exactly and in any
order, so the result does not depend on partitions or on tasks that run again; sketches of a language and of the whole
corpus are merged from those of (language, source). Partial aggregation bounds what any group sends, hot ones too.

Each measure has a fence per language and source: the upper quartile plus three times the distance of the quartiles, the
group's own or its language's if that is wider (for word length also below the lower quartile). So a source that is mostly
copies of one text, whose quartiles meet, does not shut out its other texts. Shares that are zero in nearly every text
have quartiles of zero everywhere, and a fence of zero would reject any text with one such sign: they have a least margin
besides. The fences of a group are weighted with those of its language, and these with the corpus', each counting as
``PRIOR`` documents: no number of documents turns a group's verdicts at once. Windows of eight words are told apart by
64-bit hashes: two windows of one text that differ are taken for equal with a chance of about 2**-64 for each pair.

Rows: every input row gives one output row, repeated and tied rows too; a null text has no words and fails; null
language and null source are groups of their own; an empty table gives an empty table. Only the id, text, language and
source columns are read for measuring; ``keep_good`` keeps all columns as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import column, documents, free_name, materialize

# Fixed values of the base rules.
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent
SPACE = "[ \\t\\n\\x0B\\f\\r]+"
SYMBOLS = "[#*$%&|<>]"

#: Documents that the fences of a group's language, and of the corpus, count as.
PRIOR = 50
#: measure -> (least margin, whether there is a lower fence too); measures are whole numbers.
FENCES = {
    "word_length": (0, True),  # characters of 100 words
    "symbols": (300, False),  # in 1000 words
    "repeated": (300, False),  # words of 1000
    "double_lines": (500, False),  # lines of 1000
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame, text: Column, name: str) -> DataFrame:
    """``docs`` with a struct column ``name`` of the base counts and ``n_lines``; ``text`` may be null.

    Steps that several others use are columns of their own, so each is worked out once in a row.
    """
    names = {k: free_name(docs, f"{name}_{k}") for k in ("words", "lines", "one", "two", "four", "hashes", "sorted", "places")}
    words, lines, one, two, four, hashes, ordered, places = (F.col(n) for n in names.values())
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    df = docs.withColumn(names["words"], F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE)))
    df = df.withColumn(names["lines"], F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != ""))

    def neighbours(array: Column, gap: int) -> Column:
        n = F.size(array) - gap
        return F.zip_with(F.slice(array, 1, n), F.slice(array, gap + 1, n), lambda x, y: F.xxhash64(x, y))

    # Hashes of 1, 2, 4 and then 8 words in a row.
    df = df.withColumn(names["one"], F.when(F.size(words) >= WINDOW, F.transform(words, lambda w: F.xxhash64(w))))
    for level, before, gap in (("two", one, 1), ("four", two, 2), ("hashes", four, 4)):
        df = df.withColumn(names[level], neighbours(before, gap))
    pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.withColumn(names["sorted"], F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(pairs)))
    twice = F.filter(ordered, lambda s, j: (s["h"] == F.get(ordered, j - 1)["h"]) | (s["h"] == F.get(ordered, j + 1)["h"]))
    df = df.withColumn(names["places"], F.sort_array(F.transform(twice, lambda s: s["i"])))
    n = F.size(places)
    steps = F.zip_with(F.slice(places, 1, n - 1), F.slice(places, 2, n - 1), lambda a, b: F.least(F.lit(WINDOW), b - a))
    repeated = F.when(places.isNull(), 0).otherwise(F.aggregate(steps, F.lit(WINDOW), lambda a, x: a + x))
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SYMBOLS)),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": repeated,
        "n_lines": F.size(lines),
    }
    df = df.withColumn(name, F.struct(*[c.cast("long").alias(k) for k, c in counts.items()]))
    return df.drop(*names.values())


def base_failed(m: Column) -> Column:
    return (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"])


def _measures(m: Column) -> dict[str, Column]:
    def share(part: Column, whole: Column, scale: int) -> Column:
        return F.when(whole > 0, F.floor(part * scale / whole)).otherwise(0).cast("long")

    return {
        "word_length": share(m["word_chars"], m["n_words"], 100),
        "symbols": share(m["n_symbols"], m["n_words"], 1000),
        "repeated": share(m["n_repeat_words"], m["n_words"], 1000),
        "double_lines": share(m["n_dup_lines"], m["n_lines"], 1000),
    }


def _bucket_low(v: Column) -> Column:
    """Least number of the bucket of ``v``: its first six binary digits, the rest zero."""
    drop = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, drop), drop)


def _bucket_high(low: Column) -> Column:
    """Greatest number of the bucket that begins with ``low``."""
    return low + F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.length(F.bin(low)) - 6, F.lit(0))) - 1


def fences(df: DataFrame, m: str, lang: Column, source: Column) -> DataFrame:
    """(lang, source, fences): for each measure the lowest and highest number that is kept."""
    values = F.explode(F.array(*[F.struct(F.lit(k).alias("measure"), _bucket_low(v).alias("low")) for k, v in _measures(F.col(m)).items()]))
    own = df.select(lang.alias("lang"), source.alias("source"), values.alias("v")).groupBy("lang", "source", "v.measure", "v.low").agg(F.count("*").alias("n"))
    own = materialize(own, "sketches")
    # Merged sketches: level 0 the group, 1 its language, 2 the corpus.
    merged = own.select(F.lit(0).alias("level"), "lang", "source", "measure", "low", "n")
    merged = merged.unionAll(own.groupBy("lang", "measure", "low").agg(F.sum("n").alias("n")).select(F.lit(1), "lang", F.lit(None).cast("string"), "measure", "low", "n"))
    merged = merged.unionAll(own.groupBy("measure", "low").agg(F.sum("n").alias("n")).select(F.lit(2), F.lit(None).cast("string"), F.lit(None).cast("string"), "measure", "low", "n"))
    key = ["level", "lang", "source", "measure"]
    whole = Window.partitionBy(*key)
    so_far = whole.orderBy("low").rowsBetween(Window.unboundedPreceding, 0)
    ranked = merged.select(*key, "low", F.sum("n").over(so_far).alias("upto"), F.sum("n").over(whole).alias("total"))
    quartiles = ranked.groupBy(*key).agg(
        F.max("total").alias("n"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("low"))).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("low"))).alias("q3"),
    )
    quartiles = quartiles.withColumn("q3", _bucket_high(F.col("q3")))
    limits = F.create_map(*[F.lit(x) for k, v in FENCES.items() for x in (k, v[0])])[F.col("measure")]
    below = F.create_map(*[F.lit(x) for k, v in FENCES.items() for x in (k, v[1])])[F.col("measure")]
    wide = quartiles.withColumn("below", below).withColumn("margin", limits.cast("long"))
    wide = wide.groupBy("level", "lang", "source").agg(F.max("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("measure", F.struct("q1", "q3", "below", "margin")))).alias("f"))
    # A group, its language and the corpus.
    none = F.lit(None).cast("string")
    levels = [F.struct(F.lit(k).alias("of"), a.alias("of_lang"), b.alias("of_source")) for k, a, b in ((0, F.col("lang"), F.col("source")), (1, F.col("lang"), none), (2, none, none))]
    wanted = own.select("lang", "source").distinct().select("lang", "source", F.inline(F.array(*levels)))
    wide = wide.withColumnsRenamed({"lang": "at_lang", "source": "at_source"})
    same = (F.col("of") == F.col("level")) & F.col("of_lang").eqNullSafe(F.col("at_lang")) & F.col("of_source").eqNullSafe(F.col("at_source"))
    three = wanted.join(wide, same).groupBy("lang", "source")
    three = three.agg(*[F.any_value(F.when(F.col("level") == k, F.col(c)), True).alias(f"{c}{k}") for k in range(3) for c in ("n", "f")])
    return materialize(three.select("lang", "source", F.map_from_entries(F.array(*[F.struct(F.lit(k), _weighted(k)) for k in FENCES])).alias("fences")), "fences")


def _weighted(measure: str) -> Column:
    """The fence of a row with the counts ``n0`` .. ``n2`` and the quartiles ``f0`` .. ``f2`` of its three levels."""
    least, most = [], []
    for k in range(3):
        own, wider = F.col(f"f{k}")[measure], F.col(f"f{max(k, 1)}")[measure]
        margin = F.greatest(3 * (own["q3"] - own["q1"]), 3 * (wider["q3"] - wider["q1"]), own["margin"])
        least.append(F.when(own["below"], F.greatest(own["q1"] - margin, F.lit(0))).otherwise(0))
        most.append(own["q3"] + margin)

    def mixed(x: list[Column]) -> Column:
        out = x[2]
        for k in (1, 0):
            out = F.call_function("div", F.col(f"n{k}") * x[k] + PRIOR * out, F.col(f"n{k}") + PRIOR)
        return out

    return F.struct(mixed(least).alias("least"), mixed(most).alias("most"))


def judged(df: DataFrame, m: str, lang: Column, source: Column, verdict: str) -> DataFrame:
    """``df``, which has the measured struct ``m``, with the boolean ``verdict``; the sketches are read from ``df``."""
    bounds = fences(df, m, lang, source)
    names = [free_name(df, f"fence_{c}") for c in ("lang", "source", "fences")]
    bounds = bounds.toDF(*names)
    joined = df.join(bounds, lang.eqNullSafe(bounds[names[0]]) & source.eqNullSafe(bounds[names[1]]), "left")
    within = F.lit(True)
    for k, v in _measures(F.col(m)).items():
        fence = F.col(names[2])[k]
        within = within & (v >= fence["least"]) & (v <= fence["most"])
    return joined.withColumn(verdict, ~base_failed(F.col(m)) & within).drop(*names)


def rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Counts and verdict of every row; the texts are read once, the narrow counts are written and joined."""
    narrow = docs.select(column(docs, id_col).cast("long").alias("doc_id"), column(docs, lang_col).cast("string").alias("lang"), column(docs, source_col).cast("string").alias("source"), column(docs, text_col).cast("string").alias("text"))
    narrow = materialize(measured(narrow, F.col("text"), "m").drop("text"), "measured")
    out = judged(narrow, "m", narrow["lang"], narrow["source"], "kept")
    return out.select("doc_id", *[F.col("m")[k].alias(k) for k in BASE], base_failed(F.col("m")).alias("base_failed"), "kept")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    m, verdict = free_name(docs, "measured"), free_name(docs, "verdict")
    df = materialize(measured(docs, column(docs, text_col).cast("string"), m), "measured")
    out = judged(df, m, column(df, lang_col).cast("string"), column(df, source_col).cast("string"), verdict)
    return out.where(F.col(verdict)).select(*[column(out, c) for c in docs.columns])


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules(documents(spark, sf_dir))


_VALUES = ", ".join(f"('{k}', {margin}, {str(below).lower()})" for k, (margin, below) in FENCES.items())

OP3_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')) AS l
  FROM documents
), win AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c
  FROM (SELECT r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS k
        FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW}))
), rep AS (
  SELECT r, sum(least({WINDOW}, step)) AS n
  FROM (SELECT r, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, {WINDOW}) AS step FROM win WHERE c > 1) GROUP BY r
), m AS (
  SELECT d.r, doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines
  FROM d LEFT JOIN rep ON d.r = rep.r
), v AS (
  SELECT r, lang, source, 'word_length' AS measure, CASE WHEN n_words > 0 THEN word_chars * 100 // n_words ELSE 0 END AS v FROM m
  UNION ALL SELECT r, lang, source, 'symbols', CASE WHEN n_words > 0 THEN n_symbols * 1000 // n_words ELSE 0 END FROM m
  UNION ALL SELECT r, lang, source, 'repeated', CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END FROM m
  UNION ALL SELECT r, lang, source, 'double_lines', CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END FROM m
), b AS (
  SELECT *, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS low FROM v
), s AS (
  SELECT 0 AS level, lang, source, measure, low, count(*) AS n FROM b GROUP BY ALL
  UNION ALL SELECT 1, lang, NULL, measure, low, count(*) FROM b GROUP BY ALL
  UNION ALL SELECT 2, NULL, NULL, measure, low, count(*) FROM b GROUP BY ALL
), q AS (
  SELECT level, lang, source, measure, max(total) AS n, min(CASE WHEN upto * 4 >= total THEN low END) AS q1,
         min(CASE WHEN upto * 4 >= total * 3 THEN low END) AS q3
  FROM (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY low) AS upto,
               sum(n) OVER (PARTITION BY level, lang, source, measure) AS total FROM s)
  GROUP BY ALL
), h AS (
  SELECT level, lang, source, measure, n, q1, q3 + (1::BIGINT << greatest(length(bin(q3)) - 6, 0)) - 1 AS q3 FROM q
), f AS (
  SELECT h.level, h.lang, h.source, h.measure, h.n,
         CASE WHEN below THEN greatest(h.q1 - greatest(3 * (h.q3 - h.q1), 3 * (c.q3 - c.q1), margin), 0) ELSE 0 END AS least,
         h.q3 + greatest(3 * (h.q3 - h.q1), 3 * (c.q3 - c.q1), margin) AS most
  FROM h JOIN (VALUES {_VALUES}) AS t(measure, margin, below) ON t.measure = h.measure
  JOIN h AS c ON c.measure = h.measure AND c.level = greatest(h.level, 1) AND (h.level = 2 OR c.lang IS NOT DISTINCT FROM h.lang)
), l AS (
  SELECT l.lang, l.measure, (l.n * l.least + {PRIOR} * a.least) // (l.n + {PRIOR}) AS least, (l.n * l.most + {PRIOR} * a.most) // (l.n + {PRIOR}) AS most
  FROM f AS l JOIN f AS a ON l.level = 1 AND a.level = 2 AND a.measure = l.measure
), w AS (
  SELECT g.lang, g.source, g.measure, (g.n * g.least + {PRIOR} * l.least) // (g.n + {PRIOR}) AS least, (g.n * g.most + {PRIOR} * l.most) // (g.n + {PRIOR}) AS most
  FROM f AS g JOIN l ON g.level = 0 AND g.lang IS NOT DISTINCT FROM l.lang AND g.measure = l.measure
), bad AS (
  SELECT DISTINCT b.r
  FROM b JOIN w ON w.lang IS NOT DISTINCT FROM b.lang AND w.source IS NOT DISTINCT FROM b.source AND w.measure = b.measure
  WHERE b.v < w.least OR b.v > w.most
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words,
       n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
       NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) AND bad.r IS NULL AS kept
FROM m LEFT JOIN bad ON m.r = bad.r
"""
