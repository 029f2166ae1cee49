"""CIGAR strings and aligned bases as Column expressions. Intervals are 0-based and half-open."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ampliscope.functions.dna import piece, upto

#: An operation with where it lies on reference and query.
OP = "struct<op:string,n:int,ref:int,query:int>"


def parse(cigar: Column) -> Column:
    """(n, op) of each operation; null for an empty string or `*`."""
    parts = F.regexp_extract_all(cigar, F.lit(r"(\d+[MIDNSHP=X])"), F.lit(1))
    ops = F.transform(parts, lambda p: F.struct(F.regexp_extract(p, r"^\d+", 0).cast("int").alias("n"), F.right(p, F.lit(1)).alias("op")))
    return F.when((F.length(cigar) > 0) & (cigar != "*"), ops)


def text(ops: Column) -> Column:
    return F.array_join(F.transform(ops, lambda o: F.concat(o["n"].cast("string"), o["op"])), "")


def _sum(ops: Column, kinds: str) -> Column:
    wanted = F.filter(ops, lambda o: o["op"].isin(*kinds))
    return F.coalesce(F.aggregate(F.transform(wanted, lambda o: o["n"]), F.lit(0), lambda a, x: a + x), F.lit(0))


def reference_length(cigar: Column) -> Column:
    return _sum(parse(cigar), "MDN=X")


def query_length(cigar: Column) -> Column:
    return _sum(parse(cigar), "MIS=X")


def span_md(cigar: Column) -> Column:
    """Bases of M and D; null if it has other operations than M, I, D, S and H; 0 for `*`."""
    return F.when(cigar == "*", 0).when(cigar.rlike(r"^(\d+[MIDSH])+$"), _sum(parse(cigar), "MD"))


def soft_clips(cigar: Column) -> Column:
    return _sum(parse(cigar), "S")


def inserted(cigar: Column) -> Column:
    return _sum(parse(cigar), "I")


def deleted(cigar: Column) -> Column:
    return _sum(parse(cigar), "D")


def clip_5(cigar: Column) -> Column:
    return F.coalesce(F.regexp_extract(cigar, r"^(?:\d+H)?(\d+)S", 1).try_cast("int"), F.lit(0))


def clip_3(cigar: Column) -> Column:
    return F.coalesce(F.regexp_extract(cigar, r"(\d+)S(?:\d+H)?$", 1).try_cast("int"), F.lit(0))


def operations(cigar: Column, start: Column) -> Column:
    """(op, n, ref, query): every operation with where it begins. `=` and `X` are M."""
    first = F.struct(F.array().cast(f"array<{OP}>").alias("out"), start.cast("int").alias("ref"), F.lit(0).alias("query"))

    def step(acc: Column, o: Column) -> Column:
        op = F.when(o["op"].isin("=", "X"), "M").otherwise(o["op"])
        row = F.struct(op.alias("op"), o["n"].alias("n"), acc["ref"].alias("ref"), acc["query"].alias("query"))
        ref = acc["ref"] + F.when(op.isin("M", "D", "N"), o["n"]).otherwise(0)
        query = acc["query"] + F.when(op.isin("M", "I", "S"), o["n"]).otherwise(0)
        return F.struct(F.concat(acc["out"], F.array(row)).alias("out"), ref.alias("ref"), query.alias("query"))

    return F.aggregate(F.coalesce(parse(cigar), F.array().cast("array<struct<n:int,op:string>>")), first, step, lambda acc: acc["out"])


def _touches(first: Column, last: Column, region: tuple | None) -> Column:
    if region is None:
        return F.lit(True)
    return ~((last < region[0]) | (first > region[1]))


def deletions(ops: Column, ref: Column, least: int = 1, region: tuple | None = None) -> Column:
    """(position, sequence) of deletions of at least `least` bases whose closed interval meets the region."""
    wanted = F.filter(ops, lambda o: (o["op"] == "D") & (o["n"] >= least) & _touches(o["ref"], o["ref"] + o["n"], region))
    return F.transform(wanted, lambda o: F.struct(o["ref"].alias("position"), F.substring(ref, o["ref"] + 1, o["n"]).alias("sequence"), o["n"].alias("n")))


def insertions(ops: Column, read: Column, least: int = 1, region: tuple | None = None) -> Column:
    """(position, sequence) of insertions, each before the base at its position."""
    wanted = F.filter(ops, lambda o: (o["op"] == "I") & (o["n"] >= least) & _touches(o["ref"], o["ref"], region))
    return F.transform(wanted, lambda o: F.struct(o["ref"].alias("position"), F.substring(read, o["query"] + 1, o["n"]).alias("sequence"), o["n"].alias("n")))


def pairs(ops: Column, read: Column, ref: Column) -> Column:
    """(ref, query, base, ref_base) of every aligned base inside both sequences."""
    matched = F.filter(ops, lambda o: o["op"] == "M")
    each = lambda o: F.transform(
        F.filter(upto(o["n"] - 1, 0), lambda i: (o["ref"] + i < F.length(ref)) & (o["query"] + i < F.length(read))),
        lambda i: F.struct((o["ref"] + i).alias("ref"), (o["query"] + i).alias("query"), F.substring(read, o["query"] + i + 1, F.lit(1)).alias("base"), F.substring(ref, o["ref"] + i + 1, F.lit(1)).alias("ref_base")),
    )
    return F.flatten(F.transform(matched, each))


def mismatches(ops: Column, read: Column, ref: Column) -> Column:
    """The aligned bases that differ. An operation without a difference costs one comparison."""
    matched = F.filter(ops, lambda o: (o["op"] == "M") & (F.substring(read, o["query"] + 1, o["n"]) != F.substring(ref, o["ref"] + 1, o["n"])))
    return F.filter(pairs(matched, read, ref), lambda p: p["base"] != p["ref_base"])


def mismatch_signature(found: Column) -> Column:
    """`pos:ref>alt` of mismatches, sorted by position."""
    rows = F.array_sort(F.transform(found, lambda p: F.struct(p["ref"].alias("p"), p["ref_base"].alias("r"), p["base"].alias("b"))))
    return F.array_join(F.transform(rows, lambda x: F.concat(x["p"].cast("string"), F.lit(":"), x["r"], F.lit(">"), x["b"])), ",")


def md_mismatches(md: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_replace(md, r"\^[A-Z]+", ""), "[^A-Za-z]", ""))


def alignment_mismatches(nm: Column, cigar: Column, md: Column) -> Column:
    """Substitutions: edit distance less indel bases, else letters of the MD tag."""
    return F.coalesce(F.greatest(F.lit(0), nm - inserted(cigar) - deleted(cigar)), md_mismatches(md), F.lit(0))


def penalty(aligned: Column, mismatches: Column, clips: Column) -> Column:
    return F.when(aligned, (mismatches + clips).cast("double")).otherwise(F.lit(float("inf")))


def query_offset(ops: Column, ref0: Column, extrapolate: bool = True) -> Column:
    """The query base at a reference position, into the clips beyond the ends; null inside a deletion."""
    inside = F.filter(ops, lambda o: (o["op"] == "M") & (o["ref"] <= ref0) & (ref0 < o["ref"] + o["n"]))
    hit = F.transform(inside, lambda o: o["query"] + ref0 - o["ref"])
    aligned = F.filter(ops, lambda o: o["op"] == "M")
    first, last = F.try_element_at(aligned, F.lit(1)), F.try_element_at(aligned, F.lit(-1))
    total = F.try_element_at(ops, F.lit(-1))
    before, after = first["query"] - (first["ref"] - ref0), last["query"] + ref0 - last["ref"]
    end = F.array_max(F.transform(ops, lambda o: o["query"] + F.when(o["op"].isin("M", "I", "S"), o["n"]).otherwise(0)))
    out = F.try_element_at(hit, F.lit(1))
    if not extrapolate:
        return out
    return F.coalesce(out, F.when((ref0 < first["ref"]) & (before >= 0), before), F.when((ref0 >= last["ref"] + last["n"]) & (after < end) & total.isNotNull(), after))


def anchors(ops: Column, start: Column, end: Column) -> Column:
    """(left, right): aligned bases before and after a deletion [start, end)."""
    total = lambda keep: F.aggregate(F.transform(F.filter(ops, lambda o: (o["op"] == "M") & keep(o)), lambda o: o["n"]), F.lit(0), lambda a, x: a + x)
    return F.struct(total(lambda o: o["ref"] + o["n"] <= start).alias("left"), total(lambda o: o["ref"] >= end).alias("right"))


def boundary_defect(ops: Column, found: Column, bases: int, from_end: bool, length: Column) -> Column:
    """Whether an indel, a soft clip or a mismatch lies in the first or last `bases` bases of the query."""
    low, high = (length - bases, length) if from_end else (F.lit(0), F.lit(bases))
    bad = F.exists(ops, lambda o: (o["op"].isin("I", "S") & (o["query"] < high) & (o["query"] + o["n"] > low)) | ((o["op"] == "D") & (o["query"] > low) & (o["query"] < high)))
    return bad | F.exists(found, lambda p: (p["query"] >= low) & (p["query"] < high))


def reference_slice(ref: Column, start: Column, end: Column) -> Column:
    return piece(ref, start, end)
