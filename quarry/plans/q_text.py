"""Bindings for SURVEY 2.9: strings and text mining."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import strings as fs
from quarry.operators import text as tx
from quarry.plans.registry import register
from quarry.session import load

S = "2.9"
W = r"\p{L}+"


def _sql_values(rows, cols):
    vals = ", ".join("(" + ", ".join(repr(v) for v in r) + ")" for r in rows)
    return f"(VALUES {vals}) t({', '.join(cols)})"


TOKENS_SQL = "SELECT doc_id, lang, source, unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS word FROM documents"
TOKENS_POS_SQL = ("SELECT doc_id, CAST(generate_subscripts(regexp_extract_all(lower(text), '\\p{L}+'), 1) - 1 AS INTEGER) AS pos, "
                  "unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS word FROM documents")


def _tokens(spark, sf, pos=False):
    return tx.tokenize_words(load(spark, sf, "documents"), "text", keep=["doc_id", "lang", "source"], with_position=pos)


@register("str_detect", section=S, sql="""
SELECT doc_id, regexp_matches(lower(text), 'licen[cs]e') AS has_license, regexp_matches(text, '[0-9]{4}') AS has_year FROM documents""")
def str_detect(spark, sf):
    d = load(spark, sf, "documents")
    return d.select("doc_id", fs.str_detect(F.lower("text"), "licen[cs]e").alias("has_license"),
                    fs.str_detect("text", "[0-9]{4}").alias("has_year"))


@register("str_replace", section=S, sql="""
SELECT doc_id, md5(regexp_replace(text, '[0-9]+', '#')) AS first_md5, md5(regexp_replace(text, '[0-9]+', '#', 'g')) AS all_md5 FROM documents""")
def str_replace(spark, sf):
    d = load(spark, sf, "documents")
    return d.select("doc_id", F.md5(fs.str_replace_first("text", "[0-9]+", "#")).alias("first_md5"),
                    F.md5(fs.str_replace_all("text", "[0-9]+", "#")).alias("all_md5"))


@register("str_backreference", section=S, sql="""
SELECT o_orderkey, regexp_replace(o_orderpriority, '^([0-9])-([A-Z ]+)$', '\\2 (\\1)') AS label FROM orders""")
def str_backreference(spark, sf):
    return load(spark, sf, "orders").select(
        "o_orderkey", fs.str_replace_all("o_orderpriority", r"^([0-9])-([A-Z ]+)$", "$2 ($1)").alias("label"))


@register("str_split", section=S, sql="""
SELECT doc_id, CAST(len(regexp_split_to_array(text, '[.!?]\\s+')) AS INTEGER) AS n_sentences,
       regexp_split_to_array(text, '[.!?]\\s+')[1] = text AS single FROM documents""")
def str_split(spark, sf):
    parts = F.split("text", r"[.!?]\s+")
    return load(spark, sf, "documents").select("doc_id", F.size(parts).alias("n_sentences"),
                                               (parts[0] == F.col("text")).alias("single"))


@register("str_case_trim", section=S, sql="""
SELECT doc_id, md5(lower(trim(text))) AS lower_md5, CAST(length(trim(text)) AS INTEGER) AS n_trimmed FROM documents""")
def str_case_trim(spark, sf):
    t = F.trim("text")
    # upper() is not compared: Java maps "ß" to "SS", DuckDB keeps it
    return load(spark, sf, "documents").select("doc_id", F.md5(F.lower(t)).alias("lower_md5"),
                                               F.length(t).alias("n_trimmed"))


@register("str_concat", section=S, sql="""
SELECT event_id, CAST(user_id AS VARCHAR) || '-' || event_type AS user_kind, printf('%s:%.2f', event_type, value) AS label FROM events""")
def str_concat(spark, sf):
    return load(spark, sf, "events").select(
        "event_id", fs.paste("user_id", "event_type", sep="-").alias("user_kind"),
        F.format_string("%s:%.2f", "event_type", "value").alias("label"))


@register("parse_number", section=S, sql="""
SELECT o_orderkey, '$' || format('{:,.2f}', o_totalprice) || ' for ' || o_custkey || '-' || o_orderkey AS txt,
       o_totalprice AS parsed FROM orders""")
def parse_number(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", F.concat(
        F.lit("$"), F.format_number("o_totalprice", 2), F.lit(" for "), "o_custkey", F.lit("-"), "o_orderkey").alias("txt"))
    return o.withColumn("parsed", fs.parse_number("txt"))


# Number words replaced by digits in measurement text.
NUMBER_WORDS = (("one", "1"), ("two", "2"), ("three", "3"), ("four", "4"), ("five", "5"))


@register("clean_measure_text", section=S, sql="""
WITH raw AS (SELECT o_orderkey, '"' || replace(CAST(round(o_totalprice / 1000, 1) AS VARCHAR), '.', ',') || ' k" x ' ||
                    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'one' WHEN '2' THEN 'two' WHEN '3' THEN 'three'
                    WHEN '4' THEN 'four' ELSE 'five' END AS raw FROM orders)
SELECT o_orderkey, raw, TRY_CAST(replace(regexp_replace(regexp_replace(raw, '^"([0-9,]+) k" x .*$', '\\1'), '"', '', 'g'), ',', '.') AS DOUBLE) AS thousands,
       CAST(replace(replace(replace(replace(replace(regexp_extract(raw, 'x ([a-z]+)$', 1), 'one', '1'), 'two', '2'), 'three', '3'), 'four', '4'), 'five', '5') AS INTEGER) AS count
FROM raw""")
def clean_measure_text(spark, sf):
    o = load(spark, sf, "orders")
    word = F.element_at(F.create_map(*[F.lit(x) for kv in zip("12345", [w for w, _ in NUMBER_WORDS]) for x in kv]),
                        F.substring("o_orderpriority", 1, 1))
    raw = F.concat(F.lit('"'), F.regexp_replace(F.round(F.col("o_totalprice") / 1000, 1).cast("string"), r"\.", ","),
                   F.lit(' k" x '), word)
    d = o.select("o_orderkey", raw.alias("raw"))
    num = F.regexp_replace(F.regexp_replace(F.regexp_replace("raw", r'^"([0-9,]+) k" x .*$', "$1"), '"', ""), ",", ".")
    cnt = F.regexp_extract("raw", "x ([a-z]+)$", 1)
    for w, digit in NUMBER_WORDS:
        cnt = F.regexp_replace(cnt, w, digit)
    return d.select("o_orderkey", "raw", num.try_cast("double").alias("thousands"), cnt.cast("int").alias("count"))


@register("parse_text_table", section=S, sql=r"""
WITH l AS (SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS line_no,
                  unnest(string_split(text, chr(10))) AS line FROM documents),
     nb AS (SELECT * FROM l WHERE trim(line) <> ''),
     c AS (SELECT doc_id, line_no, CAST(generate_subscripts(regexp_split_to_array(trim(line), '\s{2,}'), 1) - 1 AS INTEGER) AS col,
                  unnest(regexp_split_to_array(trim(line), '\s{2,}')) AS value FROM nb),
     f AS (SELECT doc_id, min(line_no) AS line_no FROM nb GROUP BY 1),
     h AS (SELECT doc_id, col, trim(regexp_replace(lower(value), '[^\p{L}\p{N}]+', '_', 'g')) AS name FROM c JOIN f USING (doc_id, line_no))
SELECT doc_id, line_no, col, name, value FROM c LEFT JOIN h USING (doc_id, col)""")
def parse_text_table(spark, sf):
    return tx.text_table(load(spark, sf, "documents"), "doc_id", "text")


@register("tokenize_words", section=S, sql=f"""
SELECT lang, word, count(*) AS n FROM ({TOKENS_SQL}) GROUP BY 1, 2""")
def tokenize_words(spark, sf):
    return tx.word_counts(_tokens(spark, sf), ["lang"])


@register("tokenize_regex", section=S, sql=r"""
SELECT doc_id, unnest(regexp_extract_all(regexp_replace(text, 'https?://\S+', '', 'g'), '[#@][\p{L}'']*|[\p{L}'']+')) AS word
FROM documents""")
def tokenize_regex(spark, sf):
    d = load(spark, sf, "documents")
    return tx.tokenize_split(d, "text", r"[^\p{L}#@']+|(?=[#@])", strip_pattern=r"https?://\S+", keep=["doc_id"])


@register("stopwords_removed", section=S, sql=f"""
SELECT word, count(*) AS n FROM ({TOKENS_SQL}) WHERE word NOT IN ({", ".join(repr(w) for w in tx.STOP_WORDS)}) GROUP BY word""")
def stopwords_removed(spark, sf):
    stop = tx.lexicon(spark, [(w,) for w in tx.STOP_WORDS], "word STRING")
    return tx.word_counts(tx.remove_stop_words(_tokens(spark, sf).select("word"), stop))


@register("word_counts", section=S, sql=f"""
WITH c AS (SELECT source, word, count(*) AS n FROM ({TOKENS_SQL}) GROUP BY 1, 2 HAVING count(*) > 100)
SELECT source, word, n, CAST(rank() OVER (PARTITION BY source ORDER BY n DESC) AS INTEGER) AS rank FROM c""")
def word_counts(spark, sf):
    c = tx.word_counts(_tokens(spark, sf), ["source"], min_n=100)
    from pyspark.sql import Window
    return c.withColumn("rank", F.rank().over(Window.partitionBy("source").orderBy(F.col("n").desc())))


@register("sentiment_score", section=S, sql=f"""
SELECT doc_id, count(*) AS n_scored, round(avg(score), 6) AS mean_score, round(avg(CASE WHEN score > 0 THEN 1.0 ELSE 0.0 END), 6) AS share_positive
FROM ({TOKENS_SQL}) JOIN {_sql_values(tx.SENTIMENT_SCORES, ['word', 'score'])} USING (word) GROUP BY doc_id""")
def sentiment_score(spark, sf):
    lex = tx.lexicon(spark, tx.SENTIMENT_SCORES, "word STRING, score INT")
    s = tx.sentiment_score(_tokens(spark, sf), lex, ["doc_id"])
    return s.select("doc_id", "n_scored", F.round("mean_score", 6).alias("mean_score"),
                    F.round("share_positive", 6).alias("share_positive"))


@register("sentiment_category_counts", section=S, sql=f"""
WITH l AS (SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS line_no,
                  unnest(string_split(text, chr(10))) AS line FROM documents),
     t AS (SELECT doc_id, line_no, unnest(regexp_extract_all(lower(line), '\\p{{L}}+')) AS word FROM l)
SELECT doc_id, floor(line_no / 80) AS chunk, count(*) FILTER (WHERE sentiment = 'positive') AS positive,
       count(*) FILTER (WHERE sentiment = 'negative') AS negative,
       count(*) FILTER (WHERE sentiment = 'positive') - count(*) FILTER (WHERE sentiment = 'negative') AS net
FROM t JOIN {_sql_values(tx.SENTIMENT_CATEGORIES, ['word', 'sentiment'])} USING (word) GROUP BY 1, 2""")
def sentiment_category_counts(spark, sf):
    lines = load(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    toks = tx.tokenize_words(lines, "line", keep=["doc_id", "line_no"])
    lex = tx.lexicon(spark, tx.SENTIMENT_CATEGORIES, "word STRING, sentiment STRING")
    out = tx.sentiment_by_chunk(toks, lex, ["doc_id"], "line_no")
    return out.select("doc_id", F.col("chunk").cast("double").alias("chunk"), "positive", "negative", "net")


# The flagged word list for the match ratio.
FLAGGED = ("damn", "hell", "crap", "dumb", "stupid", "idiot", "shut", "kill", "ugly", "hate")


@register("swear_ratio", section=S, sql=f"""
WITH t AS (SELECT source, word, CASE WHEN length(word) > 4 THEN regexp_replace(word, '(ing|ed|es|ly|s)$', '') ELSE word END AS stem
           FROM ({TOKENS_SQL})),
     w AS (SELECT * FROM (VALUES {", ".join(f"('{w}')" for w in FLAGGED)}) v(w)),
     s AS (SELECT DISTINCT CASE WHEN length(w) > 4 THEN regexp_replace(w, '(ing|ed|es|ly|s)$', '') ELSE w END AS st FROM w)
SELECT source, count(*) AS n_tokens,
       count(*) FILTER (WHERE word IN (SELECT w FROM w) OR stem IN (SELECT st FROM s)) AS n_matched,
       round(avg(CASE WHEN word IN (SELECT w FROM w) OR stem IN (SELECT st FROM s) THEN 1.0 ELSE 0.0 END), 8) AS ratio
FROM t GROUP BY source""")
def swear_ratio(spark, sf):
    words = tx.lexicon(spark, [(w,) for w in FLAGGED], "word STRING")
    r = tx.match_ratio(_tokens(spark, sf), words, ["source"])
    return r.select("source", "n_tokens", "n_matched", F.round("ratio", 8).alias("ratio"))


@register("log_odds_words", section=S, sql=f"""
WITH c AS (SELECT word, count(*) FILTER (WHERE lang = 'en') AS en, count(*) FILTER (WHERE lang = 'fr') AS fr
           FROM ({TOKENS_SQL}) WHERE lang IN ('en', 'fr') GROUP BY word),
     t AS (SELECT sum(en + 1) AS ta, sum(fr + 1) AS tb FROM c)
SELECT word, en, fr, round(log2(((en + 1) / ta) / ((fr + 1) / tb)), 8) AS log_ratio FROM c, t WHERE en + fr >= 20""")
def log_odds_words(spark, sf):
    counts = tx.word_counts(_tokens(spark, sf), ["lang"])
    lo = tx.log_odds(counts, "lang", "en", "fr")
    return lo.where(F.col("en") + F.col("fr") >= 20).select("word", "en", "fr", F.round("log_ratio", 8).alias("log_ratio"))


@register("word_bigrams", section=S, sql=f"""
WITH t AS ({TOKENS_POS_SQL}),
     b AS (SELECT word || ' ' || lead(word) OVER (PARTITION BY doc_id ORDER BY pos) AS bigram FROM t)
SELECT bigram, count(*) AS n FROM b WHERE bigram IS NOT NULL GROUP BY bigram HAVING count(*) >= 5""")
def word_bigrams(spark, sf):
    b = tx.text_bigrams(load(spark, sf, "documents"), "text")
    return b.groupBy("bigram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 5)
