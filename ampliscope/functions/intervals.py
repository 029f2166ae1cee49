"""Interval and flag predicates of alignments. Intervals here are closed unless a name says otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ampliscope.functions.cigar import span_md

UNMAPPED, SECONDARY, DUPLICATE, SUPPLEMENTARY = 0x4, 0x100, 0x400, 0x800


def mapped(flag: Column) -> Column:
    return flag.bitwiseAND(F.lit(UNMAPPED)) == 0


def primary(flag: Column) -> Column:
    return flag.bitwiseAND(F.lit(UNMAPPED | SECONDARY | SUPPLEMENTARY)) == 0


def duplicate(flag: Column, mode: str = "standard") -> Column:
    """The duplicate bit; or, as `parity`, the 11th digit from the left of the flag in binary."""
    if mode == "parity":
        return F.substring(F.bin(flag), 11, 1) == "1"
    return flag.bitwiseAND(F.lit(DUPLICATE)) != 0


def overlaps(l1: Column, r1: Column, l2: Column, r2: Column) -> Column:
    return ~((r1 < l2) | (l1 > r2))


def contains(l1: Column, r1: Column, l2: Column, r2: Column) -> Column:
    """Whether [l1, r1] lies within [l2, r2]."""
    return (l1 >= l2) & (r1 <= r2)


def clipped_at(left: Column, right: Column, start: Column, cigar: Column, flex: int) -> Column:
    """Whether a read is soft-clipped at its start near `left`, or else at its end near `right`."""
    at_start, at_end = cigar.rlike(r"^\d+S"), cigar.rlike(r"\d+S$")
    return F.when(at_start & (F.abs(start - left) <= flex), True).when(~at_start & at_end, F.abs(start + span_md(cigar) - right) <= flex).otherwise(False)


def nested_gap(s1: Column, e1: Column, s2: Column, e2: Column, least: int = 1000) -> Column:
    """Whether one read's span lies strictly inside the other's, which is longer by over `least`."""
    inside = ((s1 < s2) & (e2 < e1)) | ((s2 < s1) & (e1 < e2))
    outer, inner = F.greatest(e1 - s1, e2 - s2), F.least(e1 - s1, e2 - s2)
    return inside & (outer > inner + least)


def bins(start: Column, end: Column, width: int) -> Column:
    """The bins of an interval, for an equi-join ahead of the exact test."""
    return F.sequence(F.floor(start / width).cast("long"), F.floor(end / width).cast("long"))
