"""Microhomology and overlap of sequences as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ampliscope.functions.dna import piece, upto


def _longest(n: Column, match) -> Column:
    """The largest i up to n for which match(i) holds, 0 if none does; a shorter miss doesn't stop it."""
    return F.coalesce(F.array_max(F.filter(upto(n), match)), F.lit(0))


def indel_homology(kind: Column, position: Column, sequence: Column, ref: Column) -> Column:
    """(left, right): how much of an indel's start equals what ends before it, and of its end what
    follows; for an insertion its end what ends before it, and its start what follows."""
    n, deletion = F.length(sequence), kind == "deletion"
    end = position + F.when(deletion, n).otherwise(0)
    before = lambda i: piece(ref, position - i, position)
    after = lambda i: piece(ref, end, end + i)
    head, tail = (lambda i: F.substring(sequence, F.lit(1), i)), (lambda i: F.right(sequence, i))
    room = F.length(ref) - end
    left = F.when(deletion, _longest(F.least(n, position), lambda i: head(i) == before(i))).otherwise(_longest(F.least(n, position), lambda i: tail(i) == before(i)))
    right = F.when(deletion, _longest(F.least(n, room), lambda i: tail(i) == after(i))).otherwise(_longest(F.least(n, room), lambda i: head(i) == after(i)))
    inside = (n > 0) & (room >= 0)
    return F.struct(F.when(inside, left).otherwise(0).alias("left"), F.when(inside, right).otherwise(0).alias("right"))


def indel_range(kind: Column, position: Column, sequence: Column, ref: Column) -> Column:
    """(first, last): where an indel could lie as well, as the bases around it repeat it."""
    h = indel_homology(kind, position, sequence, ref)
    n = F.length(sequence)
    whole = (n > 0) & ((kind != "deletion") | (position + n <= F.length(ref)))
    last = position + F.when(kind == "deletion", n).otherwise(0) + h["right"]
    return F.struct(F.when(whole, position - h["left"]).otherwise(position).alias("first"), F.when(whole, last).otherwise(position).alias("last"))


def near_cut(kind: Column, position: Column, sequence: Column, ref: Column, cut: Column, window: int = 1) -> Column:
    r = indel_range(kind, position, sequence, ref)
    return (r["first"] <= cut + window) & (r["last"] >= cut - window)


def deletion_homology(ref: Column, start: Column, end: Column, most: int = 20) -> Column:
    """(left, right, left_seq, right_seq) of a deletion [start, end), up to `most` bases."""
    gone = piece(ref, start, end)
    n = F.length(gone)
    left = _longest(F.least(F.lit(most), n, start), lambda i: F.substring(gone, F.lit(1), i) == piece(ref, start - i, start))
    right = _longest(F.least(F.lit(most), n, F.length(ref) - end), lambda i: F.right(gone, i) == piece(ref, end, end + i))
    return F.struct(left.alias("left"), right.alias("right"), F.substring(gone, F.lit(1), left).alias("left_seq"), F.when(right > 0, F.right(gone, right)).otherwise("").alias("right_seq"))


def deletion_mechanism(ref: Column, start: Column, end: Column, over: int = 2) -> Column:
    h = deletion_homology(ref, start, end)
    return F.when(F.greatest(h["left"], h["right"]) > over, "mmej").otherwise("nhej")


def _while_equal(n: Column, match) -> Column:
    """How many of match(1), match(2), ... hold before the first that doesn't, up to n."""
    first_miss = F.array_min(F.filter(upto(n), lambda i: ~match(i)))
    return F.coalesce(first_miss - 1, F.greatest(n, F.lit(0)))


def junction_mirror(insertion: Column, left: Column, right: Column, most: int = 15) -> Column:
    """(left, right, class): bases of an insertion that mirror its flanks, base by base from the junction."""
    n_left = _while_equal(F.least(F.lit(most), F.length(insertion), F.length(left)), lambda i: F.substring(insertion, i, F.lit(1)) == F.substring(F.reverse(left), i, F.lit(1)))
    n_right = _while_equal(F.least(F.lit(most), F.length(insertion), F.length(right)), lambda i: F.substring(F.reverse(insertion), i, F.lit(1)) == F.substring(right, i, F.lit(1)))
    most_of = F.greatest(n_left, n_right)
    return F.struct(n_left.alias("left"), n_right.alias("right"), F.when(most_of >= 5, "MMEJ_STRONG").when(most_of >= 2, "MMEJ_WEAK").otherwise("NHEJ").alias("class"))


def junction_overlap(insertion: Column, left: Column, right: Column, most: int = 15) -> Column:
    """(left, right, class): an insertion's start equal to the left flank's end, and its end to the right flank's start."""
    n_left = _while_equal(F.least(F.lit(most), F.length(insertion), F.length(left)), lambda i: F.right(left, i) == F.substring(insertion, F.lit(1), i))
    n_right = _while_equal(F.least(F.lit(most), F.length(insertion), F.length(right)), lambda i: F.right(insertion, i) == F.substring(right, F.lit(1), i))
    m = F.greatest(n_left, n_right)
    empty = (F.length(insertion) == 0) | (F.length(left) == 0) | (F.length(right) == 0)
    return F.struct(n_left.alias("left"), n_right.alias("right"), F.when(empty, "UNKNOWN").when(m <= 1, "NHEJ").when(m <= 5, "MMEJ_SHORT").otherwise("MMEJ_EXTENDED").alias("class"))


def shared_end(a: Column, b: Column, least: int = 2, most: int = 10) -> Column:
    """The longest end of a that is a start of b, of `least` to `most` bases, else empty."""
    n = F.array_max(F.filter(upto(F.least(F.lit(most), F.length(a), F.length(b)), least), lambda i: F.right(a, i) == F.substring(b, F.lit(1), i)))
    return F.when(n.isNotNull(), F.right(a, n)).otherwise("")


def overlap(a: Column, b: Column, least: int = 10) -> Column:
    """Whether an end of one, of at least `least` bases, is a start of the other."""
    n = upto(F.least(F.length(a), F.length(b)), least)
    return F.exists(n, lambda i: (F.right(a, i) == F.substring(b, F.lit(1), i)) | (F.right(b, i) == F.substring(a, F.lit(1), i)))


def merge_reads(r1: Column, r2: Column, least: int = 20, wrong: float = 0.1, joiner: str = "NNNNNNNNNN") -> Column:
    """r1 and the turned r2 merged at their longest overlap with few mismatches, else joined by Ns."""
    differ = lambda i: F.size(F.filter(upto(i), lambda k: F.substring(F.right(r1, i), k, F.lit(1)) != F.substring(r2, k, F.lit(1))))
    n = F.array_max(F.filter(upto(F.least(F.length(r1), F.length(r2)), least), lambda i: differ(i) <= i * wrong))
    return F.when(n.isNotNull(), F.concat(r1, F.substring(r2, n + 1, F.length(r2)))).otherwise(F.concat(r1, F.lit(joiner), r2))


def amplicon(ref: Column, site: Column, flank: int = 140) -> Column:
    return piece(ref, F.greatest(F.lit(0), site - flank), F.least(F.length(ref), site + flank))


def best_offset(ref: Column, donor: Column) -> Column:
    """(matches, offset): where an ungapped donor agrees with most bases of ref, the first on a tie."""
    score = lambda o: F.size(F.filter(upto(F.length(donor)), lambda k: F.substring(donor, k, F.lit(1)) == F.substring(ref, o + k, F.lit(1))))
    all_of = F.transform(upto(F.length(ref) - F.length(donor), 0), lambda o: F.struct(score(o).alias("matches"), (-o).alias("back")))
    best = F.array_max(all_of)
    return F.struct(best["matches"].alias("matches"), (-best["back"]).alias("offset"))


def fuzzy_insertion(seen: Column, expected: Column) -> Column:
    """Whether an inserted sequence is one expected: equal, one within the other, or, of five bases and
    more, equal over half of the shorter after a shift of up to three."""
    n, m = F.length(seen), F.length(expected)
    half = F.floor(F.least(n, m) / 2)

    def shifted(o: int) -> Column:
        a = F.substring(seen, F.lit(o + 1), n) if o >= 0 else piece(seen, F.lit(0), F.greatest(F.lit(0), F.least(n, m + o)))
        b = F.substring(expected, F.lit(1), F.length(a)) if o >= 0 else F.substring(expected, F.lit(1 - o), m)
        return (F.length(a) >= half) & (a == b)

    some = shifted(-3)
    for o in range(-2, 4):
        some = some | shifted(o)
    return (seen == expected) | expected.contains(seen) | seen.contains(expected) | ((n >= 5) & (m >= 5) & some)
