"""SimHash near-dedup: fingerprints of word shingles, linked through pigeonhole blocks.

Two 64-bit fingerprints that differ in at most `distance` of `distance + 2` blocks
agree in two whole blocks at least: each pair of blocks is a join key, and the
Hamming distance of the pairs that share one is verified. Equal fingerprints are one
node. A bucket of over `HOT` fingerprints isn't paired: its fingerprints meet at
midpoints instead (two differ in at most two bits exactly if both are within one bit
of a common value), which gives the same links with 65 rows for each.

Defined cases: a text that is null or has no word has fingerprint zero, linked like
any other; fewer words than a shingle: the whole sequence is one shingle. Repeated
rows keep a row each; rows without doc_id take part and tie others together, but give
no component id (a component of such rows alone has none). Only a `distance` of 2 is
offered, as midpoints are exact for no other.
An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampliscope.llm.common import materialize, ship
from ampliscope.llm.components import connected_components

SEED = 42
DISTANCE = 2
#: Fingerprints of a bucket that are paired with each other; those of larger buckets meet at midpoints.
HOT = 64
#: Shingles of one text that are counted at a time.
CHUNK = 1 << 16


def shingle_hashes(text: bytes, size: int) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of the words of a text, in bounded chunks."""
    words = text.lower().split()  # of bytes: A-Z and the six ASCII spaces only
    if not words:
        return
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(size, len(words))
    a, b = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(a), CHUNK):
        yield np.array([digest(line[x:y], SEED) for x, y in zip(a[i : i + CHUNK], b[i : i + CHUNK])], dtype="<u8")


def fingerprint(text: bytes, size: int) -> int:
    """Bit i is 1 if it is set in over half of the shingles' hashes."""
    ones, n = np.zeros(64, np.int64), 0
    for h in shingle_hashes(text, size):
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0]) if n else 0


def _print_rows(size: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            prints = pa.array([fingerprint(t or b"", size) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), prints], names=["doc_id", "print"])

    return rows


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, print) of every text; print is the fingerprint as a signed long."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_print_rows(size), "doc_id long, print long")


def _blocks(column: str, distance: int) -> list:
    """A key for each pair of the distance + 2 blocks: its number and the bits of both."""
    n = distance + 2
    cuts = [64 * i // n for i in range(n + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return [F.struct(F.lit(k).alias("k"), F.col(column).bitwiseAND(F.lit(signed(masks[i] | masks[j]))).alias("bits")) for k, (i, j) in enumerate(combinations(range(n), 2))]


def links(nodes: DataFrame, distance: int = DISTANCE, hot: int = HOT) -> DataFrame:
    """(a, b) of nodes (print, rep) that tie all nodes within `distance` bits of each other:
    every close pair of the smaller buckets, and for larger ones a star of those within a bit of a midpoint."""
    if distance != 2:
        raise ValueError("midpoints are exact for a distance of 2")
    keyed = nodes.select("print", "rep", F.explode(F.array(*_blocks("print", distance))).alias("b")).select("print", "rep", "b.*")
    shared = materialize(keyed.groupBy("k", "bits").count().where("count > 1"), "buckets")
    within = materialize(keyed.join(shared, ["k", "bits"]), "candidates")
    cold = within.where(F.col("count") <= hot)
    left, right = cold.select("k", "bits", F.col("print").alias("p"), F.col("rep").alias("a")), cold.select("k", "bits", F.col("print").alias("q"), F.col("rep").alias("b"))
    close = F.bit_count(F.col("p").bitwiseXOR(F.col("q"))) <= distance
    pairs = left.join(right, ["k", "bits"]).where((F.col("p") < F.col("q")) & close).select("a", "b")
    flips = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("print").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    middle = F.explode(F.concat(F.array("print"), flips))
    around = within.where(F.col("count") > hot).select("print", "rep").distinct().select("print", "rep", middle.alias("mid"))
    # At most 65 fingerprints lie within a bit of a midpoint.
    stars = around.groupBy("mid").agg(F.collect_list("rep").alias("reps")).where("size(reps) > 1").select(F.array_min("reps").alias("a"), F.explode("reps").alias("b")).where("a != b")
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, size: int = 3, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    prints = materialize(fingerprints(docs, size), "prints")
    nodes = materialize(prints.groupBy("print").agg(F.min("doc_id").alias("least")), "nodes")
    # a node is a fingerprint, whether or not any of its rows has a doc_id
    found = connected_components(links(nodes.select("print", F.col("print").alias("rep")), distance), "a", "b")
    member = nodes.join(found, nodes["print"] == found["node"], "left").select("print", "least", F.coalesce("component", "print").alias("root"))
    member = materialize(member, "members")
    least = materialize(member.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    label = materialize(member.join(least, "root").select("print", "component_id"), "labels")
    # equal fingerprints may be very many: both sides are scans, which adaptive execution can split
    hexed = F.lpad(F.lower(F.hex("print")), 16, "0")
    return prints.join(label, "print").select("doc_id", hexed.alias("fingerprint"), "component_id")
