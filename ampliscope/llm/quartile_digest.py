"""Document fingerprints: a quartile bucket digest of hashed byte triplets.

Every byte triplet of a text falls into one of 128 buckets. The digest states the
text's length class (two hex digits) and, for each bucket, in which quartile of
the text's own bucket counts its count lies (two bits). Two digests compare by a
bounded score: 1 for equal digests, 0 for a difference of `WORST` or more.

Defined cases: a null or empty text has the digest of no triplets, as have texts of
one or two bytes, told apart by their length class only. Rows with equal doc_id are
ordered by text; a null doc_id comes last. One row: it is its own next document.
An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampliscope.llm.common import begin_of, materialize, ship

BUCKETS = 128
#: A difference of this much, of at most 6 a bucket and 24 for the length, counts as unlike.
WORST = 240
LENGTH_BASE = 1.1
LENGTH_WORST = 24
#: The cost of a quartile that differs by 0, 1, 2 or 3.
STEP = np.array([0, 1, 2, 6])


#: Triplets that are counted at a time.
CHUNK = 1 << 16


def digest(data: bytes) -> str:
    b = np.frombuffer(data, dtype=np.uint8)
    length = min(255, int(math.log(len(b), LENGTH_BASE)) + 1) if len(b) else 0
    quartile = np.zeros(BUCKETS, dtype=np.uint8)
    if len(b) >= 3:
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for i in range(0, len(b) - 2, CHUNK):
            w = b[i : i + CHUNK + 2].astype(np.uint32)
            key = w[:-2] | (w[1:-1] << np.uint32(8)) | (w[2:] << np.uint32(16))
            key *= np.uint32(2654435761)
            counts += np.bincount(key >> np.uint32(25), minlength=BUCKETS)
        q = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
        quartile = (counts[:, None] > q).sum(1).astype(np.uint8)
    four = quartile.reshape(-1, 4)
    packed = four[:, 0] | (four[:, 1] << 2) | (four[:, 2] << 4) | (four[:, 3] << 6)
    return f"{length:02x}{packed.tobytes().hex()}"


def likeness(a: str, b: str) -> float:
    """1 for equal digests, 0 for those that differ by WORST or more."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(d[2:]), dtype=np.uint8) for d in (a, b))
    score = min(LENGTH_WORST, abs(int(a[:2], 16) - int(b[:2], 16)))
    for shift in (0, 2, 4, 6):
        score += int(STEP[np.abs(((x >> shift) & 3).astype(int) - ((y >> shift) & 3))].sum())
    return max(0.0, 1.0 - score / WORST)


def edited(text: str, following: str) -> str:
    """text with its last third replaced by as much of the start of the next text, or all of it."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def _row(text: str, own: str, after: str, after_digest: str) -> tuple:
    changed = edited(text, after).encode()
    of = digest(changed)
    return len(text), hashlib.sha256(changed).hexdigest(), own, of, likeness(own, of), likeness(own, after_digest)


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range in order. The last one lacks its next text: it goes out with its own
    text, as does the first text, for the range before."""
    part = TaskContext.get().partitionId()
    kept, first = None, None
    schema = pa.schema([*zip(NAMES, TYPES), ("part", pa.int32()), ("end", pa.string()), ("text", pa.string())])

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for batch in batches:
        out = []
        # a text at a time: only it and the one before are held as Python strings
        for doc_id, cell in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = cell.as_py() or ""
            own = digest(text.encode())
            if kept is None:
                first = text
            else:
                out.append((kept[0], *_row(kept[1], kept[2], text, own), part, None, None))
            kept = doc_id, text, own
        if out:
            yield table(out)
    if kept is not None:
        blank = (None,) * 6
        yield table([(kept[0], *blank, part, "last", kept[1]), (None, *blank, part, "first", first)])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text, after in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            text, after = text.as_py(), after.as_py()
            rows.append((doc_id, *_row(text, digest(text.encode()), after, digest(after.encode()))))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), TYPES)], names=NAMES)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Digest of every text and of its edited form, with their likeness and that to the next text.

    One range shuffle by doc_id brings neighbours together; only the first and last text of
    each range cross ranges, joined by range number.
    """
    spark = docs.sparkSession
    ship(spark)
    by_id = F.col("doc_id").desc_nulls_last()
    # ranges of doc_id and a text's first bytes, not of texts, as the keys that are sampled for them go to the driver
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    laid = rows.repartitionByRange(by_id, begin_of("text").asc_nulls_first()).sortWithinPartitions(by_id, F.col("text").asc_nulls_first())
    done = materialize(laid.mapInArrow(_along, f"{RESULT}, part int, end string, text string"), "digests")
    # One number a range: as many as the shuffle has partitions.
    parts = sorted(r.part for r in done.where("end = 'first'").select("part").collect())
    follow = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, after int")
    last = done.where("end = 'last'").select("doc_id", "part", "text")
    heads = done.where("end = 'first'").select(F.col("part").alias("after"), F.col("text").alias("next_text"))
    edge = last.join(F.broadcast(follow), "part").join(heads.hint("shuffle_hash"), "after").select("doc_id", "text", "next_text")
    return done.where("end is null").select(*NAMES).unionByName(edge.mapInArrow(_joined, RESULT))
