"""SimHash near-duplicate detection with multi-index hashing.

A fingerprint bit is set if over half of a text's shingle hashes have it.  To
link fingerprints within ``max_bits`` differing bits, the 64 bits are cut into
segments with thresholds that sum to ``max_bits - segments + 1``: two such
fingerprints agree in at least one segment up to its threshold.  Each distinct
fingerprint is stored once per segment, and looks up the small Hamming ball
around its own segment value (from the lower value to the higher only, so a
pair is met once per segment); a match counts after its complete distance is
checked.  Connected components of the links give the classes.

Scale: texts are read once, by rows, and only (id, fingerprint) goes on.
Copies collapse to one fingerprint before any join, so a third of all rows
being copies is one row there.  The segment count follows the number of
distinct fingerprints by a cost model, which changes the cost but not the
result.  Nothing is collected.

Null and empty texts have no words: fingerprint zero, linked like any other.
Rows with a null id are kept; they do not name a component, so component_id is
null only if no row of a component has an id.  Repeated rows give repeated
result rows.  Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from quarry.llm.common import bounded_batches, ddl
from quarry.operators.neighbors import connected_components
from quarry.session import cut_lineage

BITS = 64
#: Hashes of a text are held this many at a time.
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash (unsigned) of one text: words between ASCII white space,
    A-Z lower-cased; XXH64 with seed 42 of the space-joined shingles."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    n = len(words) - k + 1
    ones, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for i in range(0, n, BLOCK):
        a, b = starts[i:min(i + BLOCK, n)].tolist(), ends[i + k - 1:min(i + BLOCK, n) + k - 1].tolist()
        h = np.array([digest(joined[x:y], 42) for x, y in zip(a, b)], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                 keep: Sequence[str] = ()) -> DataFrame:
    """(id, fp bigint) of every whole text, and the columns in ``keep`` as they
    are; the bits of fp are the fingerprint's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), *b.columns[2:]], names=[id_col, "fp", *keep])

    src = bounded_batches(df.select(id_col, F.col(text_col).cast("string").alias("_text"), *keep))
    return src.mapInArrow(run, ddl(src, [id_col], "fp long", keep))


def segment_plan(n: int, max_bits: int) -> list[tuple[int, int, int]]:
    """(offset, width, radius) of each segment.  Radii plus one share out
    max_bits + 1; of 2 to max_bits + 1 segments, the number with the fewest
    probes plus expected matches at n fingerprints."""
    best: tuple[float, list] | None = None
    for m in range(min(2, max_bits + 1), max_bits + 2):
        units = [(max_bits + 1) // m + (i < (max_bits + 1) % m) for i in range(m)]
        widths = [BITS // m + (i < BITS % m) for i in range(m)]
        cost = sum(sum(comb(w, r) for r in range(u)) * (1 + n / 2 ** w) for w, u in zip(widths, units))
        if best is None or cost < best[0]:
            best = (cost, [(sum(widths[:i]), widths[i], units[i] - 1) for i in range(m)])
    return best[1]


def _ball(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)]


def links(nodes: DataFrame, max_bits: int, n: int) -> DataFrame:
    """(src, dst) pairs of distinct fingerprints ``fp`` with at most
    ``max_bits`` differing bits, each at least once."""
    stored, probes = [], []
    for s, (offset, width, radius) in enumerate(segment_plan(n, max_bits)):
        value = F.shiftrightunsigned("fp", offset).bitwiseAND(F.lit((1 << width) - 1))
        seg = nodes.select(F.lit(s).alias("seg"), value.alias("value"), "fp")
        stored.append(F.struct(F.lit(s).alias("seg"), value.alias("value")))
        masks = F.array(*[F.lit(m).cast("long") for m in _ball(width, radius)])
        probes.append(seg.select("seg", "value", "fp", F.explode(masks).alias("mask"))
                      .where((F.col("mask") == 0) | (F.col("value").bitwiseXOR(F.col("mask")) > F.col("value")))
                      .select("seg", F.col("value").bitwiseXOR(F.col("mask")).alias("value"), F.col("fp").alias("src"), "mask"))
    table = nodes.select(F.explode(F.array(*stored)).alias("s"), F.col("fp").alias("dst")).select("s.seg", "s.value", "dst")
    probe = probes[0]
    for p in probes[1:]:
        probe = probe.unionByName(p)
    near = F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= max_bits
    once = F.when(F.col("mask") == 0, F.col("src") < F.col("dst")).otherwise(True)
    return probe.alias("p").join(table.alias("t"), (F.col("p.seg") == F.col("t.seg")) & (F.col("p.value") == F.col("t.value"))
                                 & near & once).select("src", "dst")


def _components(fps: DataFrame, max_bits: int) -> DataFrame:
    """(fp, cluster, component_id) of the distinct fingerprints of a table
    (id, fp): a cluster is named by its least fingerprint."""
    nodes = cut_lineage(fps.groupBy("fp").agg(F.min("id").alias("node")))
    found = cut_lineage(links(nodes.select("fp"), max_bits, nodes.count()).distinct())
    ends = found.select(F.col("src").alias("v")).union(found.select("dst")).distinct()
    comp = connected_components(found, ends)
    linked = comp.join(nodes, comp.v == nodes.fp).select("v", "component", "node")
    smallest = linked.groupBy("component").agg(F.min("node").alias("least"))
    label = linked.join(smallest, "component").select(F.col("v").alias("fp"), "component", "least")
    # written, so that a join with it can split the rows of a hot fingerprint over tasks
    return cut_lineage(nodes.join(label, "fp", "left").select("fp", F.coalesce("component", "fp").alias("cluster"),
                                                              F.coalesce("least", "node").alias("component_id")))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    max_bits: int = 4) -> DataFrame:
    """(id, fp, component_id): component_id is the smallest id reachable over
    links of at most ``max_bits`` differing bits."""
    fps = cut_lineage(fingerprints(df, id_col, text_col, shingle).withColumnRenamed(id_col, "id"))
    return fps.join(_components(fps, max_bits), "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of each near-duplicate component, with all its columns: that of
    the smallest id (of several, of the least text hash; of repeated rows, one;
    a row without an id only if the whole component has none)."""
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("none"))
    rows = df.withColumns({"_name": name, "_hash": F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))})
    fps = cut_lineage(fingerprints(rows, id_col, text_col, shingle, ("_name", "_hash")).withColumnRenamed(id_col, "id"))
    best = fps.join(_components(fps, max_bits).select("fp", "cluster"), "fp").groupBy("cluster") \
        .agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "_hash", "_name")).alias("b")).select("b._name", "b._hash")
    one = rows.groupBy("_name", "_hash").agg(F.min(F.struct(*df.columns)).alias("row"))
    return one.join(best, ["_name", "_hash"], "left_semi").select("row.*")
