"""Alignment of distinct short reads to one amplicon, for where no aligner's results are given.

Each distinct sequence is aligned once, in Arrow batches: end to end within the reference, free ends on the
reference's side, gaps affine-free as in the donors' alignment. Both strands are tried.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampliscope.operators.align import reverse_complement
from ampliscope.runtime import ship

MATCH, MISMATCH, GAP = 2, -3, -3


def place(read: str, ref: str) -> tuple[int, int, str]:
    """(score, start, cigar) of a read within a reference: all of the read, gaps opened as rarely as scores allow."""
    x, y = np.frombuffer(read.encode(), np.uint8), np.frombuffer(ref.encode(), np.uint8)
    n, m = len(x), len(y)
    table = np.zeros((n + 1, m + 1), dtype=np.int32)
    slope = np.arange(m + 1, dtype=np.int32) * -GAP
    for i in range(1, n + 1):
        row = np.empty(m + 1, dtype=np.int32)
        row[0] = i * GAP
        row[1:] = np.maximum(table[i - 1, :-1] + np.where(y == x[i - 1], MATCH, MISMATCH), table[i - 1, 1:] + GAP)
        table[i] = np.maximum.accumulate(row + slope) - slope
    j = int(table[n].argmax())
    score, i, ops = int(table[n, j]), n, []
    while i:
        here = table[i, j]
        # a gap that is open stays open, so that one indel isn't torn apart by chance matches
        if ops and ops[-1] == "D" and j and here == table[i, j - 1] + GAP:
            j -= 1
            ops.append("D")
        elif ops and ops[-1] == "I" and here == table[i - 1, j] + GAP:
            i -= 1
            ops.append("I")
        elif j and here == table[i - 1, j - 1] + (MATCH if x[i - 1] == y[j - 1] else MISMATCH):
            i, j = i - 1, j - 1
            ops.append("M")
        elif here == table[i - 1, j] + GAP:
            i -= 1
            ops.append("I")
        else:
            j -= 1
            ops.append("D")
    runs = [(len(list(g)), op) for op, g in groupby(reversed(ops))]
    # an insertion at an end is a soft clip
    runs = [(k, "S" if op == "I" and e in (0, len(runs) - 1) else op) for e, (k, op) in enumerate(runs)]
    return score, j, "".join(f"{k}{op}" for k, op in runs)


def _rows(least: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, read, ref in zip(*(batch.column(i).to_pylist() for i in range(3))):
                read, ref = (read or "").upper(), (ref or "").upper()
                found = [(*place(s, ref), turned, s) for s, turned in ((read, False), (reverse_complement(read), True))] if read and ref else []
                best = max(found, key=lambda f: (f[0], not f[3]), default=None)
                if best is None or best[0] < least * MATCH * len(read):
                    out.append((key, False, None, None, None, None, None))
                else:
                    out.append((key, True, best[1], best[2], best[3], best[4], best[0]))
            types = [pa.string(), pa.bool_(), pa.int32(), pa.string(), pa.bool_(), pa.string(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=["seq_hash", "is_mapped", "ref_start", "cigar", "is_reverse", "read_seq", "score"])

    return rows


def align_distinct(sequences: DataFrame, least: float = 0.4) -> DataFrame:
    """(seq_hash, is_mapped, ref_start, cigar, is_reverse, read_seq, score) of distinct sequences (seq_hash, sequence,
    ref_seq); unmapped under `least` of the best score that a read can have."""
    ship(sequences.sparkSession)
    rows = sequences.select(F.col("seq_hash"), "sequence", "ref_seq")
    return rows.mapInArrow(_rows(least), "seq_hash string, is_mapped boolean, ref_start int, cigar string, is_reverse boolean, read_seq string, score int")
