"""Queries of this package over the harness tables, and their DuckDB SQL.

Each takes (spark, sf_dir) and applies one operator, with production
parameters, to its whole table.  Digest columns are derived here from what the
operators return.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarry.llm import (byte_bpe, decontaminate, filter_audit, html_text, simhash, sketches, suffix_dedup, token_counts,
                        topk_search, toxicity, url_filter, va_file, warc)
from quarry.session import ensure_checkpoint_dir, load

BYTE_BPE = "byte_bpe_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"

#: Fixed rules: (verdict, host/path).
URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))


def labelled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(url, block) of pages whose document is labelled: a page's url ends its
    path with the number of the document it was made from, and low quality or
    toxicity of that document blocks."""
    number = F.regexp_extract(F.coalesce("url", F.lit("")), r"://[^?#]*/(\d{1,18})(?:\.[a-z]+)?/?(?:[?#]|$)", 1)
    pages = load(spark, sf_dir, "pages").select("url", F.when(number != "", number).cast("long").alias("doc_id"))
    labels = load(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("block"))
    return pages.join(labels, "doc_id").select("url", "block")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    rules = url_filter.mine_rules(labelled_pages(spark, sf_dir))
    return url_filter.judge(load(spark, sf_dir, "pages"), rules, URL_RULES)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontaminate.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        decontaminate.contaminated().alias("contaminated"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document, decode the ids again, and digest both."""
    path = public_tokenizers.path(BYTE_BPE)
    ids = byte_bpe.encode(load(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return byte_bpe.digests(byte_bpe.decode(ids, path, public_tokenizers.PATTERN))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity, most probable grade and verdict of every document."""
    docs = load(spark, sf_dir, "documents")
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).withColumn("toxic", toxicity.rejected())


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document."""
    return token_counts.token_counts(load(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page into archives in the shared folder and read them back."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    warc.write_archives(load(spark, sf_dir, "pages"), path)
    return warc.records(warc.read_archives(spark, path, payload=False)) \
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _covered(spans: str) -> Column:
    """Bytes in flat spans: every second end less the starts."""
    signed = F.transform(spans, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    return F.aggregate(signed, F.lit(0).cast("long"), lambda a, x: a + x)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated strings of 400 bytes;
    then bytes and spans that repeated strings of 200 bytes cover, which passages of just over 50 words have."""
    cut = suffix_dedup.remove_repeats(load(spark, sf_dir, "documents"), min_len=400, also=[200])
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                      F.floor(F.size("spans") / 2).alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
                      _covered("spans_200").alias("n_repeated_200"), F.floor(F.size("spans_200") / 2).alias("n_spans_200"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketch of every document, of its edited text, and their likeness."""
    made = sketches.edited_fingerprints(load(spark, sf_dir, "documents"))
    own = F.col("sketch")
    return made.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       sketches.to_text(own).alias("fingerprint"), sketches.to_text(F.col("edited_sketch")).alias("edited_fingerprint"),
                       sketches.resemblance(own, F.col("edited_sketch")).alias("near_edited"),
                       sketches.resemblance(own, F.col("next_sketch")).alias("near_next"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page."""
    return html_text.extract(load(spark, sf_dir, "pages"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes, in every order, per language."""
    return filter_audit.filter_audit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector against all others."""
    vectors = load(spark, sf_dir, "embeddings")
    found = topk_search.search(vectors, vectors.where(topk_search.divisible("vec_id", 50)))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after ten rounds, and its distance."""
    made = va_file.centroid_clusters(load(spark, sf_dir, "embeddings"))
    return made.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
                       F.sha2(F.array_join("centroid", ","), 256).alias("centroid_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_url_filter, op2_decontaminate, op3_byte_bpe, op4_toxicity, op5_token_counts, op6_warc,
                                 op7_simhash, op8_suffix_dedup, op9_fingerprints, op10_html_text, op11_filter_audit,
                                 op12_topk_search, op13_centroid_clusters)
}

#: DuckDB SQL of the queries that SQL can express.
SQL: dict[str, str] = {}

SQL["op2_decontaminate"] = r"""
WITH iw AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (SELECT DISTINCT item, array_to_string(w[i:i + 12], ' ') AS win, len(w[i:i + 12]) AS k
         FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM wins),
dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dp AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, ks)),
hit AS (SELECT doc_id, k, i, win FROM dp WHERE win IN (SELECT win FROM wins)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS s
        FROM (SELECT DISTINCT h.doc_id, wins.item FROM (SELECT DISTINCT doc_id, win FROM hit) h JOIN wins USING (win)) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""

SQL["op6_warc"] = """
WITH d AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((((instr('0123456789abcdef', substr(h, 5 * i // 4 + 1, 1)) - 1) * 16
        + instr('0123456789abcdef', substr(h, 5 * i // 4 + 2, 1)) - 1) >> CAST(3 - i % 4 AS INT)) & 31 AS BIGINT), 1)), '') AS payload_digest FROM d),
r AS (SELECT payload_digest, max(page_id) AS response FROM b GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = response THEN NULL ELSE response END AS refers_to
FROM b JOIN r USING (payload_digest)
"""

SQL["op11_filter_audit"] = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
least_id AS (SELECT text, min(doc_id) AS first_id FROM t GROUP BY 1),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
          FROM labels GROUP BY 1),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(marks.toxic, 0) AS toxic,
        (CASE WHEN len(w) < 100 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END)
        || (CASE WHEN 100 * length(regexp_replace(t.text, '[^A-Z]', '', 'g')) > 10 * length(t.text) THEN 'C' ELSE '' END)
        || (CASE WHEN regexp_matches(t.text, '[#$%&*|]') THEN 'D' ELSE '' END) || (CASE WHEN t.doc_id > first_id THEN 'E' ELSE '' END) AS fails
      FROM t JOIN least_id ON t.text = least_id.text LEFT JOIN marks ON t.doc_id = marks.doc_id),
cells AS (SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (SELECT a.c || b.c || d.c || e.c || g.c AS filter_order FROM l a, l b, l d, l e, l g
           WHERE a.c NOT IN (b.c, d.c, e.c, g.c) AND b.c NOT IN (d.c, e.c, g.c) AND d.c NOT IN (e.c, g.c) AND e.c <> g.c),
st AS (SELECT filter_order, s AS step, substr(filter_order, s, 1) AS own, substr(filter_order, 1, s - 1) AS earlier
       FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS s)),
played AS (SELECT part, filter_order, step, own, n, good, toxic, fails, contains(fails, own) AS hit,
        earlier <> '' AND translate(earlier, fails, '') <> earlier AS gone FROM cells, st),
r AS (SELECT part, filter_order, step, own,
        CAST(sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END) AS BIGINT) AS kept,
        CAST(sum(CASE WHEN NOT gone AND hit THEN n ELSE 0 END) AS BIGINT) AS removed,
        CAST(sum(CASE WHEN gone AND hit THEN n ELSE 0 END) AS BIGINT) AS redundant,
        CAST(sum(CASE WHEN fails = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
        CAST(sum(CASE WHEN NOT gone AND hit AND good = 1 THEN n ELSE 0 END) AS BIGINT) AS good_lost,
        CAST(sum(CASE WHEN NOT gone AND hit AND toxic = 1 THEN n ELSE 0 END) AS BIGINT) AS toxic_lost FROM played GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r
"""

SQL["op12_topk_search"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def _rounds_sql(rounds: int = 10, k: int = 8) -> str:
    """Assignment and floored means, round by round, over components in rows."""
    parts = [f"""
WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS cluster, v AS c
    FROM (SELECT sha256('3:' || CAST(vec_id AS VARCHAR)) AS h, v FROM v ORDER BY h LIMIT {k}))"""]
    near = "(SELECT vec_id, v, cluster, c, CAST(list_sum(list_transform(v, lambda x, i: (x - c[i]) * (x - c[i]))) AS BIGINT) AS distance FROM v, c{i})"
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT vec_id, v, cluster, distance FROM (SELECT *, row_number() OVER
    (PARTITION BY vec_id ORDER BY distance, cluster) AS r FROM {near.format(i=i)}) WHERE r = 1)""")
        if i < rounds:
            parts.append(f"""m{i} AS (SELECT cluster, p, CAST(floor_div AS BIGINT) AS x FROM (SELECT cluster, p,
    (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS floor_div
    FROM (SELECT cluster, unnest(v) AS x, unnest(range(1, 65)) AS p FROM a{i}) GROUP BY cluster, p)),
c{i + 1} AS MATERIALIZED (SELECT o.cluster, coalesce(n.c, o.c) AS c FROM c{i} o LEFT JOIN
    (SELECT cluster, list(x ORDER BY p) AS c FROM m{i} GROUP BY 1) n ON o.cluster = n.cluster)""")
    return ",\n".join(parts) + f"""
SELECT vec_id, CAST(a.cluster AS INT) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.cluster = c.cluster"""


SQL["op13_centroid_clusters"] = _rounds_sql()
