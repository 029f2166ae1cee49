"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

Only how many pieces have each length matters for the packing, and there are at most
`size` lengths. So the driver packs counts by length, not pieces. Bins are fixed many
at a time, as long as the proof holds for all of them: each step uses a length up or
leaves few of it, so the driver's work and the plan that it hands out are bounded by
the sequence size (24 runs for each length), whatever the input. The plan
says which ranks within a length go to which sequences; each piece finds its place
from its rank, which is made of counts by (length, salt) and a row number within.

Reduction: a bin {j, k} is fixed for good if no bin with j can be better, that is,
if k fills the bin exactly, or no second piece fits beside j and k is the largest
that does, or only two more fit and no two have a larger sum than k. A piece that
nothing fits beside is fixed alone. What is left is packed best-fit decreasing.

Defined cases: a null or empty text has no ids but the end id. Rows with equal
doc_id are packed each. An empty table gives an empty table. Other columns are not
read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ampliscope.llm.common import materialize, ship, slices, trimmed, utf8
from ampliscope.llm.tokens import encoder, vocabulary_path

SIZE = 2048
END_ID = 0
#: Pieces of one length and salt that a task numbers, about; at least so many salts.
NUMBERED, SALTS = 20_000, 256

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Plan:
    """The packing of counts by length. runs: (length, first rank, pieces, first sequence, offset)."""

    def __init__(self, counts: dict[int, int], size: int):
        self.size, self.left = size, np.zeros(size + 1, dtype=np.int64)
        for length, n in counts.items():
            self.left[length] += n
        self.next_rank = np.zeros(size + 1, dtype=np.int64)
        self.sequences, self.runs = 0, []
        self._reduce()
        self.fixed = self.sequences
        self._best_fit()

    def _put(self, length: int, n: int, sequence: int, offset: int) -> None:
        self.runs.append((length, int(self.next_rank[length]), n, sequence, offset))
        self.next_rank[length] += n
        self.left[length] -= n

    def _fix(self, lengths: list[int], n: int) -> None:
        offset = 0
        for length in lengths:
            self._put(length, n, self.sequences, offset)
            offset += length
        self.sequences += n

    def _partners(self, j: int) -> tuple[list[int], int]:
        """The set that dominates every bin with a piece of length j, and how often; empty if none is proven."""
        room = self.size - j
        there = self.left.copy()
        there[j] -= 1
        fits = np.flatnonzero(there[: room + 1])
        if not len(fits):
            return [j], int(self.left[j]) if j > room else 1
        k = int(fits[-1])
        often = int(self.left[j] // 2 if k == j else min(self.left[j], self.left[k]))
        if k == room:
            return [j, k], often
        least = np.repeat(fits[:3], np.minimum(there[fits[:3]], 3))[:3]
        if len(least) < 2 or least[0] + least[1] > room:
            return [j, k], often
        if (len(least) < 3 or least.sum() > room) and self._best_pair(fits, there, room) <= k:
            # the proof looks at three pieces of a length at most: it holds while so many of j and k are left besides
            spare = min(self.left[j], self.left[k]) - 4
            return [j, k], max(1, int(spare // 2 if k == j else spare))
        return [], 0

    @staticmethod
    def _best_pair(fits: np.ndarray, there: np.ndarray, room: int) -> int:
        best, i, j = 0, 0, len(fits) - 1
        while i <= j:
            total = int(fits[i] + fits[j])
            if total > room:
                j -= 1
            else:
                if i < j or there[fits[i]] > 1:
                    best = max(best, total)
                i += 1
        return best

    def _reduce(self) -> None:
        changed = True
        while changed:
            changed = False
            for j in range(self.size, 0, -1):
                while self.left[j]:
                    lengths, n = self._partners(j)
                    if not lengths:
                        break
                    self._fix(lengths, n)
                    changed = True

    def _best_fit(self) -> None:
        free: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for length in range(self.size, 0, -1):
            while n := int(self.left[length]):
                room = min((r for r, bins in free.items() if r >= length and bins), default=0)
                if room:
                    first, bins = free[room].pop()
                    m = min(n, bins)
                    if m < bins:
                        free[room].append((first + m, bins - m))
                    self._put(length, m, first, self.size - room)
                    free[room - length].append((first, m))
                    continue
                each = min(self.size // length, n)
                bins = n // each
                for i in range(each):
                    self._put(length, bins, self.sequences, i * length)
                free[self.size - each * length].append((self.sequences, bins))
                self.sequences += bins


def _pieces(path: str, size: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        end = np.array([END_ID], dtype="<u4")
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            at, data = utf8(batch.column(1))
            for a, b in slices(at):
                out = []
                for doc_id, ids in zip(doc_ids[a:b], encode(data[at[i] : at[i + 1]].tobytes() for i in range(a, b))):
                    ids = np.concatenate((ids, end))
                    for piece, start in enumerate(range(0, len(ids), size)):
                        own = ids[start : start + size]
                        out.append((doc_id, piece, start, len(own), zlib.crc32(own.tobytes())))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return rows


def pieces(docs: DataFrame, path: str | None = None, size: int = SIZE) -> DataFrame:
    """The documents' ids with the end id, cut at `size` where longer: place, length and checksum."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(trimmed(_pieces(path or vocabulary_path(), size)), PIECE)


def _place(runs: list[tuple], schema: str):
    runs = np.array(sorted(runs), dtype=np.int64).reshape(-1, 5)
    key = (runs[:, 0] << 44) | runs[:, 1]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", "rank"))
            run = runs[np.searchsorted(key, (length.astype(np.int64) << 44) | rank, side="right") - 1]
            columns = [batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            columns += [pa.array(run[:, 3] + rank - run[:, 1]), pa.array(run[:, 4])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return rows


def place(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """A sequence and an offset for every row of cut, a table of pieces that is cheap to read twice."""
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # `size` rows at most
    plan = Plan(counts, size)
    salts = max(SALTS, sum(counts.values()) // NUMBERED)
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    group = ["length", "salt"]
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = salted.groupBy(*group).count().select(*group, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    own = F.row_number().over(Window.partitionBy(*group).orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = salted.withColumn("own", own).join(base, group).withColumn("rank", F.col("base") + F.col("own"))
    out = f"{PIECE}, sequence_id long, offset long"
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(trimmed(_place(plan.runs, out)), out)


def pack(docs: DataFrame, path: str | None = None, size: int = SIZE) -> DataFrame:
    """Every piece of every document in a gapless place of a sequence of at most `size` ids."""
    return place(materialize(pieces(docs, path, size), "pieces"), size)
