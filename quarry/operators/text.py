"""Text mining operators.

Tokens are produced per row by JVM regex functions and counted with
grouped aggregations; lexicons (stop words, sentiment scores) are small
tables the planner broadcasts by their measured size.  Whole texts are
processed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.strings import light_stem

WORD = r"\p{L}+"

# A short English stop-word list (lower case).
STOP_WORDS = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or",
              "that", "the", "this", "to", "was", "with")

# A small word -> score lexicon in the style of AFINN
# (integer scores -5..5); callers pass their own full lexicon table.
SENTIMENT_SCORES = (("good", 3), ("great", 3), ("love", 3), ("happy", 3), ("best", 3), ("win", 4), ("like", 2),
                    ("well", 2), ("hope", 2), ("bad", -3), ("worst", -3), ("hate", -3), ("sad", -2), ("wrong", -2),
                    ("fail", -2), ("lost", -3), ("no", -1), ("not", -1), ("war", -2), ("death", -2))

# Word -> category lexicon in the style of bing.
SENTIMENT_CATEGORIES = (("good", "positive"), ("great", "positive"), ("love", "positive"), ("happy", "positive"),
                        ("best", "positive"), ("win", "positive"), ("like", "positive"), ("well", "positive"),
                        ("bad", "negative"), ("worst", "negative"), ("hate", "negative"), ("sad", "negative"),
                        ("wrong", "negative"), ("fail", "negative"), ("lost", "negative"), ("war", "negative"))


def lexicon(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A literal word list as a table.  Its size is bounded by the code that
    lists it, so it carries a broadcast hint: local-list DataFrames have no
    size statistics and the planner would otherwise pick the token side."""
    return F.broadcast(spark.createDataFrame(list(rows), schema))


def tokenize_words(df: DataFrame, text: str, keep: Sequence[str] = (), pattern: str = WORD,
                   name: str = "word", with_position: bool = False) -> DataFrame:
    """``unnest_tokens(word, text)``: lower-case word tokens, one row each."""
    df = df.select(*keep, text)
    toks = F.regexp_extract_all(F.lower(F.col(text)), F.lit(pattern), 0)
    if with_position:
        return df.select(*keep, F.posexplode(toks).alias("pos", name))
    return df.select(*keep, F.explode(toks).alias(name))


def tokenize_split(df: DataFrame, text: str, split_pattern: str, strip_pattern: str | None = None,
                   keep: Sequence[str] = (), name: str = "word") -> DataFrame:
    """Split by a custom (Java) regex, optionally after stripping matches
    of ``strip_pattern`` (e.g. URLs); empty pieces dropped."""
    df = df.select(*keep, text)
    t = F.col(text)
    if strip_pattern:
        t = F.regexp_replace(t, strip_pattern, "")
    return df.select(*keep, F.explode(F.split(t, split_pattern)).alias(name)).where(F.col(name) != "")


def remove_stop_words(tokens: DataFrame, stop: DataFrame, word: str = "word") -> DataFrame:
    """``anti_join(stop_words)``.  Lexicons are small; the planner broadcasts
    them by measured size (no hint on caller-supplied tables)."""
    return tokens.join(stop, on=word, how="left_anti")


def word_counts(tokens: DataFrame, by: Sequence[str] = (), word: str = "word", min_n: int = 0) -> DataFrame:
    c = tokens.groupBy(*by, word).agg(F.count(F.lit(1)).alias("n"))
    return c.where(F.col("n") > min_n) if min_n else c


def sentiment_score(tokens: DataFrame, lex: DataFrame, by: Sequence[str], word: str = "word",
                    score: str = "score") -> DataFrame:
    """Join the score lexicon; mean score, matched words and share positive
    per group."""
    j = tokens.join(lex, on=word)
    return j.groupBy(*by).agg(F.count(F.lit(1)).alias("n_scored"), F.avg(score).alias("mean_score"),
                              F.avg((F.col(score) > 0).cast("double")).alias("share_positive"))


def sentiment_by_chunk(lines_tokens: DataFrame, lex: DataFrame, by: Sequence[str], line: str, size: int = 80,
                       word: str = "word", category: str = "sentiment") -> DataFrame:
    """bing-style: positive - negative per chunk of ``size`` lines."""
    j = lines_tokens.join(lex, on=word) \
        .withColumn("chunk", F.floor(F.col(line) / size))
    return j.groupBy(*by, "chunk").agg(
        F.count_if(F.col(category) == "positive").alias("positive"),
        F.count_if(F.col(category) == "negative").alias("negative")) \
        .withColumn("net", F.col("positive") - F.col("negative"))


def match_ratio(tokens: DataFrame, words: DataFrame, by: Sequence[str], word: str = "word") -> DataFrame:
    """Share of tokens matched by a word list either directly or by their
    light stem (``swear_ratio``)."""
    stems = words.select(light_stem(F.col(word)).alias("_stem")).distinct()
    t = tokens.withColumn("_stem", light_stem(F.col(word)))
    direct = words.select(F.col(word).alias("_w"), F.lit(True).alias("_d")).distinct()
    j = t.join(direct, t[word] == direct["_w"], "left") \
        .join(stems.withColumn("_s", F.lit(True)), on="_stem", how="left")
    hit = F.coalesce(F.col("_d"), F.col("_s"), F.lit(False))
    return j.groupBy(*by).agg(F.count(F.lit(1)).alias("n_tokens"), F.count_if(hit).alias("n_matched"),
                              F.avg(hit.cast("double")).alias("ratio"))


def log_odds(counts: DataFrame, group: str, a: str, b: str, word: str = "word", n: str = "n") -> DataFrame:
    """(n+1)/sum(n+1) per group and the log2 ratio of group ``a`` to ``b``.
    Totals come from a one-row scalar subquery (no global window)."""
    wide = counts.where(F.col(group).isin(a, b)).groupBy(word).pivot(group, [a, b]).agg(F.sum(n)).na.fill(0)
    tot = wide.agg(F.struct(F.sum(F.col(a) + 1).alias("ta"), F.sum(F.col(b) + 1).alias("tb")).alias("t")).scalar()
    return wide.withColumn("log_ratio", F.log2(((F.col(a) + 1) / tot.getField("ta")) /
                                               ((F.col(b) + 1) / tot.getField("tb"))))


def bigrams(tokens_pos: DataFrame, by: Sequence[str], pos: str = "pos", word: str = "word", name: str = "bigram") -> DataFrame:
    """Adjacent token pairs within a document (``lead`` over position)."""
    nxt = F.lead(word).over(Window.partitionBy(*by).orderBy(pos))
    return tokens_pos.withColumn(name, F.when(nxt.isNotNull(), F.concat_ws(" ", F.col(word), nxt))) \
        .where(F.col(name).isNotNull())


def text_table(df: DataFrame, id_col: str, text: str, sep: str = r"\s{2,}") -> DataFrame:
    """Text lines -> table cells: every non-blank line of each document is
    split on ``sep`` (runs of 2+ spaces by default); the document's first
    line is the header, its fields cleaned into names (lower case, runs of
    other characters -> "_").  Long form: id, line_no, col, name, value."""
    lines = df.select(id_col, F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line")) \
        .where(F.trim("line") != "")
    cells = lines.select(id_col, "line_no", F.posexplode(F.split(F.trim("line"), sep)).alias("col", "value"))
    first = lines.groupBy(id_col).agg(F.min("line_no").alias("line_no"))
    header = cells.join(first, [id_col, "line_no"]).select(
        id_col, "col", F.trim(F.regexp_replace(F.lower("value"), r"[^\p{L}\p{N}]+", "_")).alias("name"))
    return cells.join(header, [id_col, "col"], "left").select(id_col, "line_no", "col", "name", "value")


def text_bigrams(df: DataFrame, text: str, keep: Sequence[str] = (), pattern: str = WORD,
                 name: str = "bigram") -> DataFrame:
    """Adjacent-token pairs built inside each row from the token array
    (``zip_with`` of the array and its one-step shift): no shuffle or sort
    of tokens by document, unlike a ``lead`` window over token positions."""
    df = df.select(*keep, text)
    toks = F.regexp_extract_all(F.lower(F.col(text)), F.lit(pattern), 0)
    pairs = F.zip_with(F.slice("_t", 1, F.greatest(F.size("_t") - 1, F.lit(0))),
                       F.slice("_t", 2, F.greatest(F.size("_t") - 1, F.lit(0))),
                       lambda a, b: F.concat_ws(" ", a, b))
    return df.select(*keep, toks.alias("_t")).select(*keep, F.explode(pairs).alias(name))
