"""Document fingerprints: bottom-k sketches of shingle hashes.

The sketch of a text is the k smallest distinct hashes of its word shingles
(five words; a shorter text is one shingle), in ascending order.  Sketches of
parts merge into the sketch of the whole, and estimate resemblance,
containment and the number of distinct shingles.  Everything here is column
expressions and joins that Spark runs in the JVM.

``edited_fingerprints`` compares every text with an edited form of it, in
which the last quarter is replaced from the next document.  Texts are
shuffled once by id (both joins read the same exchange), and what a document
takes from its successor is cut before it is sent: a quarter of the text at
most.  The successor of an id comes from a distributed row index over ids.

Null texts are empty; an empty text has an empty sketch, which equals another
empty one (likeness 1) and nothing else.  Rows that share an id each get a
result row; as someone's successor they stand for one document, that with the
least taken text.  A row with a null id has no successor (an empty one) and is
nobody's successor.  Only the id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quarry.llm.common import ascii_lower, let, shingle_hashes, split_words
from quarry.operators.relational import with_row_index

#: Hashes kept in a sketch and words in a shingle.
SKETCH, SHINGLE = 64, 5
WHITE = r"\x20\x09-\x0D"


def sketch(text: Column, k: int = SKETCH, shingle: int = SHINGLE) -> Column:
    """Bottom-k sketch (ascending array<bigint>) of a text."""
    words = F.transform(split_words(ascii_lower(text), WHITE), lambda w: F.xxhash64(w))
    none = F.array().cast("array<bigint>")
    hashes = let(words, lambda w: F.when(F.size(w) >= shingle, shingle_hashes(w, shingle))
                 .when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(none))
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = SKETCH) -> Column:
    """Sketch of the union of two shingle sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = SKETCH) -> Column:
    """Estimated Jaccard likeness: the share of the merged sketch that both have."""
    both = merge(a, b, k)
    shared = F.size(F.array_intersect(both, F.array_intersect(a, b)))
    return F.when(F.size(both) == 0, 1.0).otherwise(shared / F.size(both)).cast("double")


def distinct_count(a: Column, k: int = SKETCH) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(a, -1).cast("double") + 2.0 ** 63) / 2.0 ** 64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = SKETCH) -> Column:
    """Estimated share of a's shingles that b has: the union's estimated size
    times the resemblance, against a's estimated size."""
    shared = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_count(a, k)))


def to_text(a: Column) -> Column:
    """Sketch as text: 16 hex digits a hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def successors(df: DataFrame, id_col: str) -> DataFrame:
    """(id, next_id) over distinct non-null ids; the last one's next is the first."""
    ids = with_row_index(df.select(id_col).where(F.col(id_col).isNotNull()).distinct(), [id_col], "_pos")
    n = F.lit(ids.count())
    return ids.alias("a").join(ids.alias("b"), F.col("b._pos") == F.col("a._pos") % n + 1) \
        .select(F.col(f"a.{id_col}").alias(id_col), F.col(f"b.{id_col}").alias("next_id"))


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SKETCH,
                        shingle: int = SHINGLE) -> DataFrame:
    """(id, n_chars, edited, sketch, edited_sketch, next_sketch) of every row."""
    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    docs = rows.where(F.col("_id").isNotNull())  # the same plan in both joins, so that they share its exchange
    quarter = F.floor(F.length("_text") / 4).cast("int")
    wanted = docs.groupBy("_id").agg(F.max(quarter).alias("_take"))
    wanted = wanted.join(successors(docs, "_id"), "_id").select(F.col("_id").alias("_for"), "next_id", "_take")
    given = docs.join(wanted, docs["_id"] == wanted["next_id"]) \
        .select("_for", F.struct(F.substring("_text", F.lit(1), F.col("_take")).alias("head"),
                                 sketch(F.col("_text"), k, shingle).alias("sketch")).alias("_next")) \
        .groupBy("_for").agg(F.min("_next").alias("_next"))
    none = F.array().cast("array<bigint>")
    both = docs.join(given, docs["_id"] == given["_for"], "left") \
        .select("_id", "_text", F.coalesce("_next.head", F.lit("")).alias("_head"), F.coalesce("_next.sketch", none).alias("next_sketch")) \
        .unionByName(rows.where(F.col("_id").isNull()).select("_id", "_text", F.lit("").alias("_head"), none.alias("next_sketch")))
    kept = F.substring(F.col("_text"), F.lit(1), F.length("_text") - quarter)
    return both.select(F.col("_id").alias(id_col), F.length("_text").cast("long").alias("n_chars"),
                       F.concat(kept, F.substring(F.col("_head"), F.lit(1), quarter)).alias("edited"),
                       sketch(F.col("_text"), k, shingle).alias("sketch"), "next_sketch") \
        .withColumn("edited_sketch", sketch(F.col("edited"), k, shingle))
