"""Operator 13: URL filters by association rules, on DataFrame functions only.

A url is an item set with at most one item of each of nine kinds (top-level domain, domain, rest of the host, first
two path segments, file extension, query keys, scheme, closing slash, fragment), so that a set of any url has at most
2 ** 9 parts and frequent sets stay few, however long a url is or however often it comes. Spark's FP-growth mines the item sets of
the labelled urls together with their label; rules whose consequent is a label are kept if they reach ``SUPPORT`` and
``CONFIDENCE`` and if no rule on a part of their items, for the same label, is at least as sure.

Matching goes through an inverted index: each rule is listed under the rarest of its items, the urls' items meet it in an
equality join, and a rule fits if all its items are the url's. The surest rule wins (then more support, fewer items,
block before allow, items in order); without one the verdict is ``DEFAULT``. The index is broadcast: FP-growth itself
bounds it, as every url adds to at most 2 ** 9 sets and each set needs ``SUPPORT`` of them: 2 ** 9 / ``SUPPORT`` rules.

``op13_url_filter`` first applies the fixed rules; the pages they judge are the labels from which rules for the other
pages are mined (``labels`` has ids of documents, which say nothing about pages). The filter itself takes any labels.

Rows: every input row gives one output row, repeated rows too, and labelled ones count each time; a null url, or one
without ``://``, has an empty host and path and no items, and gets the default verdict; an empty table gives an empty
table, and without labels every url gets the default. Only the id, url and label columns are read.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, free_name, materialize

# The rules of the contract, verdict and host + path.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SUPPORT = 0.01
CONFIDENCE = 0.8
DEFAULT = "allow"
_LABEL = "label="


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What stands after the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def items_of(url: Column, host: Column, path: Column) -> Column:
    """Sorted items of a url, one of each kind at most."""
    text = F.coalesce(url, F.lit(""))
    names, steps = F.split(host, r"\."), F.split(path, "/")
    query = F.regexp_extract(text, r"^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.substring_index(x, "=", 1))
    values = {
        "tld": F.element_at(names, -1),
        "domain": F.when(F.size(names) >= 2, F.array_join(F.slice(names, -2, 2), ".")),
        "sub": F.when(F.size(names) >= 3, F.array_join(F.slice(names, 1, F.size(names) - 2), ".")),
        "first": F.get(steps, 1),
        "second": F.regexp_replace(F.coalesce(F.get(steps, 2), F.lit("")), "[0-9]+", "0"),
        "ext": F.regexp_extract(path, r"\.([^./]*)\z", 1),
        "keys": F.array_join(F.array_sort(F.array_distinct(keys)), "&"),
        "scheme": F.translate(F.substring_index(text, "://", 1), UPPER, LOWER),
        "tail": F.concat(F.when(path.endswith("/"), "/").otherwise(""), F.when(F.contains(text, F.lit("#")), "#").otherwise("")),
    }
    each = [F.when(v != "", F.concat(F.lit(f"{k}="), v)) for k, v in values.items()]
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.array_compact(F.array(*each))))


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(items, label, sure, n, anchor) of the pruned rules, from rows (items, label) with a label ``allow`` or ``block``."""
    baskets = labelled.select(F.concat("items", F.array(F.concat(F.lit(_LABEL), "label"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    frequent = materialize(model.freqItemsets, "frequent-items")
    found = model.associationRules.where(F.element_at("consequent", 1).startswith(_LABEL))
    label = F.substring(F.element_at("consequent", 1), len(_LABEL) + 1, 1000)
    both = frequent.select(F.array_join(F.array_sort("items"), "\n").alias("both"), F.col("freq").alias("n"))
    rules = found.select(F.array_sort("antecedent").alias("items"), label.alias("label"), F.col("confidence").alias("sure"), F.array_join(F.array_sort(F.concat("antecedent", "consequent")), "\n").alias("both"))
    rules = materialize(rules.join(both, "both").drop("both"), "rules")
    # Every rule asks for the rules on the parts of its items.
    parts = F.expr("transform(sequence(1, shiftleft(1, size(items)) - 2), mask -> array_join(filter(items, (x, i) -> getbit(mask, i) = 1), '\n'))")
    asked = rules.where(F.size("items") > 1).select(F.array_join("items", "\n").alias("own"), "label", "sure", F.explode(parts).alias("part"))
    general = rules.select(F.array_join("items", "\n").alias("part"), "label", F.col("sure").alias("other"))
    beaten = asked.join(general, ["part", "label"]).where("other >= sure").select("own", "label").distinct()
    rules = rules.withColumn("own", F.array_join("items", "\n")).join(beaten, ["own", "label"], "left_anti")
    # The rarest item of a rule is where the index lists it.
    single = frequent.where(F.size("items") == 1).select(F.element_at("items", 1).alias("item"), "freq")
    each = rules.select("own", "label", "sure", "n", "items", F.explode("items").alias("item")).join(single, "item")
    return each.groupBy("own", "label", "sure", "n", "items").agg(F.min_by("item", F.struct("freq", "item")).alias("anchor")).drop("own")


def judge(urls: DataFrame, rules: DataFrame, items: str, verdict: str) -> DataFrame:
    """``urls`` with the string column ``verdict`` of the surest rule that fits the item array, else the default."""
    listed = F.broadcast(rules.select("anchor", F.struct(F.col("sure"), F.col("n"), (-F.size("items")).alias("few"), (F.col("label") == "block").alias("block"), F.col("items"), F.col("label")).alias("rule")))
    row, item, best = free_name(urls, "row"), free_name(urls, "item"), free_name(urls, "best")
    keyed = urls.withColumn(row, F.monotonically_increasing_id())
    met = keyed.withColumn(item, F.explode_outer(items)).join(listed, F.col(item) == listed["anchor"], "left")
    fits = F.size(F.array_except("rule.items", items)) == 0
    out = met.groupBy(row, *[column(keyed, c) for c in urls.columns]).agg(F.max(F.when(fits, F.col("rule"))).alias(best))
    return out.withColumn(verdict, F.coalesce(F.col(best)["label"], F.lit(DEFAULT))).drop(row, best)


def fixed_rule(host: Column, path: Column) -> Column:
    """(rule, verdict) of the longest fixed rule that fits, else null."""
    longest = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, rule_host, rule_path in reversed(longest):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row: the fixed rule's verdict, else that of the mined rules."""
    url = column(pages, url_col).cast("string")
    df = pages.select(column(pages, id_col).cast("long").alias("page_id"), url.alias("url"))
    df = df.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    df = df.withColumns({"fixed": fixed_rule(F.col("host"), F.col("path")), "items": items_of(F.col("url"), F.col("host"), F.col("path"))})
    # Pages are read once; the narrow table serves mining and matching.
    df = materialize(df.drop("url"), "pages")
    rules = materialize(mine(df.where(F.col("fixed").isNotNull() & (F.size("items") > 0)).select("items", F.col("fixed.verdict").alias("label"))), "index")
    known = df.where(F.col("fixed").isNotNull()).select("page_id", "host", "path", F.col("fixed.rule").alias("rule"), F.col("fixed.verdict").alias("verdict"))
    other = judge(df.where(F.col("fixed").isNull()).select("page_id", "host", "path", "items"), rules, "items", "verdict")
    return known.unionAll(other.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), "verdict"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


_FITS = " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN {{'rule': '{h}{p}', 'verdict': '{v}'}}"
    for v, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))
)

OP13_SQL = f"""
WITH u AS (
  SELECT row_number() OVER () AS r, page_id, coalesce(url, '') AS url,
         translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), s AS (
  SELECT *, CASE {_FITS} END AS fixed, string_split(host, '.') AS names, string_split(path, '/') AS steps,
         list_filter(string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'), lambda x: x <> '') AS query
  FROM u
), k AS (
  SELECT r, page_id, host, path, fixed.rule AS rule, fixed.verdict AS verdict,
         CASE WHEN host = '' THEN [] ELSE list_sort(list_filter([
           'tld=' || names[-1],
           CASE WHEN len(names) >= 2 THEN 'domain=' || names[-2] || '.' || names[-1] END,
           CASE WHEN len(names) >= 3 THEN 'sub=' || array_to_string(names[1:len(names) - 2], '.') END,
           'first=' || coalesce(steps[2], ''),
           'second=' || regexp_replace(coalesce(steps[3], ''), '[0-9]+', '0', 'g'),
           'ext=' || regexp_extract(path, '\\.([^./]*)\\z', 1),
           'keys=' || array_to_string(list_sort(list_distinct(list_transform(query, lambda x: string_split(x, '=')[1]))), '&'),
           'scheme=' || translate(string_split(url, '://')[1], '{UPPER}', '{LOWER}'),
           'tail=' || CASE WHEN ends_with(path, '/') THEN '/' ELSE '' END || CASE WHEN contains(url, '#') THEN '#' ELSE '' END
         ], lambda x: x IS NOT NULL AND NOT regexp_matches(x, '^[a-z]+=\\z'))) END AS items
  FROM s
), parts AS (
  SELECT r, verdict, list_filter(list_transform(range(1, len(items) + 1), lambda i: CASE WHEN (mask >> (i - 1)) & 1 = 1 THEN items[i] END), lambda x: x IS NOT NULL) AS part
  FROM (SELECT r, verdict, items, unnest(range(1, 1 << len(items))) AS mask FROM k WHERE verdict IS NOT NULL AND len(items) > 0)
), least AS (
  SELECT ceil({SUPPORT}::DOUBLE * count(*)) AS c FROM k WHERE verdict IS NOT NULL AND len(items) > 0
), seen AS (
  SELECT part, count(*) AS whole, count(*) FILTER (verdict = 'allow') AS allow, count(*) FILTER (verdict = 'block') AS block FROM parts GROUP BY part
), rules AS (
  SELECT part AS items, label, n, n::DOUBLE / whole AS sure
  FROM (SELECT part, whole, 'allow' AS label, allow AS n FROM seen UNION ALL SELECT part, whole, 'block', block FROM seen)
  WHERE n > 0 AND n >= (SELECT c FROM least) AND n::DOUBLE / whole >= {CONFIDENCE}
), best AS (
  SELECT * FROM rules AS a
  WHERE NOT EXISTS (SELECT 1 FROM rules AS b WHERE b.label = a.label AND b.sure >= a.sure AND len(b.items) < len(a.items) AND list_has_all(a.items, b.items))
), m AS (
  SELECT k.r, first(label ORDER BY sure DESC, n DESC, len(best.items), label DESC, best.items DESC) AS verdict
  FROM k JOIN best ON list_has_all(k.items, best.items) WHERE k.verdict IS NULL GROUP BY k.r
)
SELECT page_id, host, path, rule, coalesce(k.verdict, m.verdict, '{DEFAULT}') AS verdict FROM k LEFT JOIN m ON k.r = m.r
"""
