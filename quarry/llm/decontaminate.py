"""Benchmark decontamination as a prefix-filtered set join.

Windows of ``window`` consecutive item words (an item with fewer is one
window) are sets of word shingles with their offsets.  The shingles are ordered
by rarity, counted over all documents.  A text that contains a window has all
of its shingles, so at full containment the necessary prefix is the one
rarest shingle: only that is joined.  A match gives the place the window must
start at; places before the text's start or past its end are dropped
(positional and length bounds), and the rest is verified word for word.

Everything is DataFrame operations.  Texts are read twice: once by rows to
find benchmark shingles, once in a join with the few candidates of each
document.  The benchmark's shingles are broadcast only if counted to be at
most ``BROADCAST_ROWS``; beyond that the same join is a shuffle join.

Null and empty texts have no words and are not contaminated.  Items without
words have no windows.  A null item id counts as one item, written as an empty
string.  Rows with the same id and text share one computation and each get a
result row, null ids included.  Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quarry.llm.common import ascii_lower, shingle_hashes, split_words
from quarry.session import cut_lineage

WINDOW, SHINGLE = 13, 5
#: At 20 bytes a row a broadcast of at most 20 MB.
BROADCAST_ROWS = 1_000_000
#: What separates words, after A-Z has been lower-cased.
SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"


def _words(text: str):
    return split_words(ascii_lower(F.col(text).cast("string")), SEPARATORS)


def _tagged(k: int, hashes):
    """Hashes of the k-word shingles; those of sizes below the usual one are told apart by their size."""
    return shingle_hashes(hashes, k) if k == SHINGLE else F.transform(shingle_hashes(hashes, k), lambda h: F.xxhash64(h, F.lit(k)))


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item, win array<string>) of every window of every item."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), _words(text_col).alias("w"))
    last = F.greatest(F.size("w") - (window - 1), F.lit(1))
    return items.where(F.size("w") > 0).select("item", F.explode(F.transform(
        F.sequence(F.lit(1), last), lambda i: F.slice("w", i, window))).alias("win")).distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, n_words, n_hit, items array<string>, text_hash) of every document:
    words inside any occurrence of a window, and the sorted items with occurring windows."""
    wins = cut_lineage(item_windows(benchmark, item_col, item_text, window))
    distinct = wins.select("win").distinct()
    hashes = F.transform(F.col("win"), lambda w: F.xxhash64(w))
    sizes = sorted({min(SHINGLE, r[0]) for r in distinct.select(F.least(F.size("win"), F.lit(SHINGLE))).distinct().collect()})
    by_size = [distinct.where(F.size("win") >= SHINGLE if k == SHINGLE else F.size("win") == k)
               .select("win", F.lit(k).alias("k"), F.posexplode(_tagged(k, hashes)).alias("at", "sh")) for k in sizes or [SHINGLE]]
    grams = by_size[0]
    for g in by_size[1:]:
        grams = grams.unionByName(g)
    grams = cut_lineage(grams)

    base = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    keyed = base.withColumn("_key", F.xxhash64("_text"))
    seen = keyed.select("_id", "_key", F.transform(_words("_text"), lambda w: F.xxhash64(w)).alias("wh"))
    seen = seen.select("_id", "_key", F.size("wh").alias("n"),
                       F.posexplode(F.concat(*[_tagged(k, F.col("wh")) for k in sizes or [SHINGLE]])).alias("i", "sh"))
    asked = grams.select("sh", "k").distinct()
    if asked.count() <= BROADCAST_ROWS:
        asked = F.broadcast(asked)
    before, skip = F.lit(0), F.lit(0)  # the arrays of smaller sizes come first
    for k in sizes:
        skip = F.when(F.col("k") == k, before).otherwise(skip)
        before = before + F.greatest(F.col("n") - (k - 1), F.lit(0))
    hits = cut_lineage(seen.join(asked, "sh").select("_id", "_key", "n", (F.col("i") - skip).alias("pos"), "sh").distinct())

    # rarity over all documents; the rarest shingle of a window is its necessary prefix
    count = hits.groupBy("sh").agg(F.count(F.lit(1)).alias("c"))
    prefix = grams.join(count, "sh", "left").groupBy("win") \
        .agg(F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "sh", "at")).alias("p")) \
        .select("win", "p.sh", "p.at")
    starts = hits.join(prefix, "sh").select("_id", "_key", "n", (F.col("pos") - F.col("at")).alias("start"), "win") \
        .where((F.col("start") >= 0) & (F.col("start") + F.size("win") <= F.col("n")))
    cands = starts.groupBy(F.col("_id").alias("_cid"), F.col("_key").alias("_ckey")).agg(F.collect_set(F.struct("start", "win")).alias("cands"))

    same = F.col("_id").eqNullSafe(F.col("_cid")) & (F.col("_key") == F.col("_ckey"))
    read = keyed.join(cands, same, "left").select("_id", "_key", _words("_text").alias("w"), "cands")
    real = F.filter("cands", lambda c: F.slice(F.col("w"), c["start"] + 1, F.size(c["win"])) == c["win"])
    covered = F.array_distinct(F.flatten(F.transform("real", lambda c: F.sequence(c["start"], c["start"] + F.size(c["win"]) - 1))))
    read = cut_lineage(read.withColumn("real", F.coalesce(real, F.array().cast("array<struct<start:int,win:array<string>>>")))
                       .select("_id", "_key", F.size("w").alias("n_words"), F.size(covered).alias("n_hit"),
                               F.array_distinct(F.transform("real", lambda c: c["win"])).alias("wins")))
    found = read.where(F.size("wins") > 0).select("_id", "_key", F.explode("wins").alias("win")).distinct() \
        .join(wins, "win").groupBy(F.col("_id").alias("_fid"), F.col("_key").alias("_fkey")) \
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    same = F.col("_id").eqNullSafe(F.col("_fid")) & (F.col("_key") == F.col("_fkey"))
    return read.join(found, same, "left").select(
        F.col("_id").alias(id_col), F.col("n_words").cast("long").alias("n_words"), F.col("n_hit").cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.col("_key").alias("text_hash"))


def contaminated(share: int = 20):
    """The rule on an n_words, n_hit row: some hit, and one word in ``share`` or more."""
    return (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    bad = contamination(docs, benchmark, id_col, text_col).where(contaminated()) \
        .select(F.col(id_col).alias("_bad_id"), F.col("text_hash").alias("_bad_key")).distinct()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col("_bad_id")) & (F.xxhash64(text) == F.col("_bad_key")), "left_anti")
