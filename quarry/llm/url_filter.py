"""URL filtering by fixed rules and mined association rules.

Spark's FP-growth mines frequent combinations of URL tokens and the label from
labelled URLs.  Rules "tokens -> block" with enough support and confidence are
kept if their blocked URLs are too many for chance, less those that a rule with
fewer tokens matches as confidently.  Chance is judged by one bound at every
size: of n URLs drawn regardless of labels, a share c or more is blocked with
probability exp(-n * KL(c, base share)) at most (Hoeffding, also without
replacement), and that must not exceed ``LEVEL``.  Tokens
that cannot be in such a rule with others are not mined: those of too few
blocked URLs, those of blocked URLs only (a rule alone), and all but one of
those that stand in the same URLs (put back into the rules).  The rules
are matched by an inverted index: a rule is listed under its rarest token, a
URL looks up its tokens, and the rule's other tokens are checked.  No URL meets
a rule it has no listed token of, and no group of URLs is gathered.

Fixed allow and block rules (a short literal list) come first; a URL that none
fits gets the mined verdict: block if a rule matches, else allow.

Null urls and urls without ``://`` have an empty host and path, fit no rule
and have no tokens: they are allowed.  Without labels nothing is mined.  Rows
with the same id and url share one computation and each get a result row.
Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from quarry.llm.common import ascii_lower
from quarry.session import cut_lineage

LABEL = "label=block"
#: A rule holds in at least this share of labelled URLs, with this confidence.
MIN_SUPPORT, MIN_CONFIDENCE = 0.002, 0.6
#: Largest chance of a rule's blocked URLs, were labels independent of tokens; 1 keeps every rule.
LEVEL = 0.001


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; empty without ``://``."""
    parts = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url.cast("string"), F.lit(""))
    return ascii_lower(F.regexp_extract(url, parts, 1)), F.regexp_extract(url, parts, 2)


def fixed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null if none fits.  A rule
    (verdict, host/path) fits its host and all subdomains if the path starts with its path."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        of, slash, start = text.partition("/")
        fits = ((host == of) | F.endswith(host, F.lit("." + of))) & F.startswith(path, F.lit(slash + start))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a url: scheme, host labels, registered domain, path
    parts, extension, query names, fragment."""
    host, path = host_and_path(url)
    full = F.coalesce(url.cast("string"), F.lit(""))
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    names = F.filter(F.split(F.regexp_extract(full, r"(?s)\?([^#]*)", 1), "[&;]"), lambda x: x != "")
    some = lambda p, c: F.when(c != "", F.array(F.concat(F.lit(p), c))).otherwise(F.array().cast("array<string>"))
    each = lambda p, c: F.transform(c, lambda x: F.concat(F.lit(p), x))
    tokens = F.concat(
        some("scheme:", F.regexp_extract(full, r"(?s)\A([A-Za-z][A-Za-z0-9+.-]*)://", 1)), each("host:", labels),
        some("domain:", F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)), some("tld:", F.regexp_extract(host, r"([^.]+)$", 1)),
        each("path:", parts), some("ext:", F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1)),
        each("query:", F.transform(names, lambda x: F.substring_index(x, "=", 1))),
        some("fragment:", F.regexp_extract(full, r"(?s)#(.*)", 1)))
    return F.when(host != "", F.array_distinct(tokens)).otherwise(F.array().cast("array<string>"))


def _evidence(hits: Column, urls: Column, base: float) -> Column:
    """-ln of Hoeffding's bound on ``hits`` or more blocked among ``urls``."""
    c = hits / urls
    rest = F.when(hits < urls, (1 - c) * F.ln((1 - c) / (1 - base))).otherwise(0.0)
    return F.when(c > base, urls * (c * F.ln(c / base) + rest)).otherwise(0.0)


def _without_stronger_parts(rules: DataFrame, count: DataFrame) -> DataFrame:
    """``rules`` without those of which a proper part of the tokens is a rule of
    at least their confidence: parts are found by the inverted index on a
    part's rarest token, among the rule's own tokens."""
    index = _rarest(rules, count).select(F.col("tokens").alias("part"), F.col("confidence").alias("of_part"), F.col("index_token").alias("token"))
    weaker = rules.where(F.size("tokens") > 1).select("tokens", "confidence", F.explode("tokens").alias("token")).join(index, "token") \
        .where((F.size("part") < F.size("tokens")) & (F.col("of_part") >= F.col("confidence")) & (F.size(F.array_except("part", "tokens")) == 0)) \
        .select("tokens").distinct()
    return cut_lineage(rules.join(weaker, "tokens", "left_anti"))


def _rarest(rules: DataFrame, count: DataFrame) -> DataFrame:
    """``rules`` with their rarest token as index_token."""
    rarest = rules.select("tokens", F.explode("tokens").alias("token")).join(count.select("token", "n"), "token") \
        .groupBy("tokens").agg(F.min(F.struct("n", "token")).alias("r")).select("tokens", F.col("r.token").alias("index_token"))
    return rules.join(rarest, "tokens").select("tokens", "index_token", "confidence", "support")


def mine_rules(labelled: DataFrame, url_col: str = "url", block_col: str = "block", min_support: float = MIN_SUPPORT,
               min_confidence: float = MIN_CONFIDENCE, level: float = LEVEL) -> DataFrame:
    """(tokens, index_token, confidence, support): block rules of a labelled table."""
    rows = cut_lineage(labelled.where(F.col(block_col).isNotNull())
                       .select(url_tokens(F.col(url_col)).alias("tokens"), F.col(block_col).cast("boolean").alias("block"))
                       .where((F.size("tokens") > 0) | F.col("block")).withColumn("row", F.monotonically_increasing_id()))
    spark = labelled.sparkSession
    n, blocked = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("block").cast("int")), F.lit(0))).first()
    base, need = blocked / max(n, 1), -math.log(level)
    # even a rule of blocked urls only needs so many of them
    least = max(1, math.ceil(min_support * n), math.ceil(need / -math.log(base) - 1e-9) if 0 < base < 1 else 1)
    if not blocked or least > blocked or (base == 1 and need > 0):
        return spark.createDataFrame([], "tokens array<string>, index_token string, confidence double, support double")
    each = rows.select("row", "block", F.explode("tokens").alias("token"))
    # no rule has a token that too few blocked urls have
    count = cut_lineage(each.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("block").cast("int")).alias("hits"), F.bit_xor(F.xxhash64("row")).alias("a"),
        F.bit_xor(F.xxhash64("row", F.lit(1))).alias("b")).where(F.col("hits") >= least))
    # a token of blocked urls only is a rule, and with more tokens a needless one; of tokens in the same urls one is mined
    sure = count.where(F.col("hits") == F.col("n")) \
        .select(F.array("token").alias("tokens"), F.lit(1.0).alias("confidence"), (F.col("hits") / n).alias("support"))
    alike = cut_lineage(count.where(F.col("hits") < F.col("n")).groupBy("n", "hits", "a", "b")
                        .agg(F.min("token").alias("token"), F.collect_list("token").alias("same")).select("token", "same"))
    mined = each.join(alike, "token").groupBy("row").agg(F.collect_list("token").alias("some"))
    items = cut_lineage(rows.select("row", "block").join(mined, "row", "left").select(F.concat(
        F.coalesce("some", F.array().cast("array<string>")),
        F.when(F.col("block"), F.array(F.lit(LABEL))).otherwise(F.array().cast("array<string>"))).alias("items")))
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(min_support, (least - 0.5) / n)), minConfidence=min_confidence).fit(items)
    rules = cut_lineage(model.associationRules.where(F.element_at("consequent", 1) == LABEL)
                        .select(F.array_sort("antecedent").alias("tokens"), "confidence", "support"))
    hits = F.round(F.col("support") * n)
    # a part of a rule that has its confidence has its evidence too, so this pruning and the next may go in either order
    if need > 0:
        rules = rules.where(_evidence(hits, F.round(hits / F.col("confidence")), base) >= need - 1e-9)
    rules = _without_stronger_parts(cut_lineage(rules), count)
    # each token stands for all that are in the same urls
    none = F.array(F.array().cast("array<string>"))
    join = lambda sets, same: F.flatten(F.transform(sets, lambda s: F.transform(same, lambda t: F.array_append(s, t))))
    rules = rules.select("*", F.explode("tokens").alias("token")).join(alike, "token") \
        .groupBy("tokens", "confidence", "support").agg(F.collect_list("same").alias("same")) \
        .select(F.explode(F.aggregate("same", none, join)).alias("tokens"), "confidence", "support") \
        .select(F.array_sort("tokens").alias("tokens"), "confidence", "support")
    kept = cut_lineage(rules.unionByName(sure))
    return cut_lineage(_rarest(kept, count))


def match_rules(urls: DataFrame, rules: DataFrame, id_col: str, url_col: str) -> DataFrame:
    """Distinct (id, url hash) that a rule matches, with the most confident one."""
    probe = urls.select(F.col(id_col).alias("_id"), F.xxhash64(url_col).alias("_key"), url_tokens(F.col(url_col)).alias("_tokens")) \
        .select("*", F.explode("_tokens").alias("index_token"))
    return probe.join(rules, "index_token").where(F.size(F.array_except("tokens", "_tokens")) == 0) \
        .groupBy("_id", "_key").agg(F.max(F.struct("confidence", "tokens")).alias("_best"))


def judge(urls: DataFrame, rules: DataFrame, fixed: Sequence[tuple[str, str]] = (), id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, mined_tokens, confidence) of every url."""
    host, path = host_and_path(F.col(url_col))
    rule, verdict = fixed_rule(F.col("host"), F.col("path"), fixed)
    base = urls.select(F.col(id_col), F.xxhash64(url_col).alias("_hash"), host.alias("host"), path.alias("path"))
    best = match_rules(urls, rules, id_col, url_col)
    mined = F.when(F.col("_best").isNotNull(), "block").otherwise("allow")
    return base.join(best, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_key")), "left") \
        .select(id_col, "host", "path", rule.alias("rule"), F.coalesce(verdict, mined).alias("verdict"),
                F.array_join("_best.tokens", " ").alias("mined_tokens"), F.col("_best.confidence").alias("confidence"))
