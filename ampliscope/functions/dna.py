"""DNA strings as Column expressions. Positions are 0-based unless a name says otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The standard genetic code, codons in TCAG order, '*' is stop.
CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = {a + b + c: CODE[16 * i + 4 * j + k] for i, a in enumerate("TCAG") for j, b in enumerate("TCAG") for k, c in enumerate("TCAG")}

#: IUPAC codes and their complements.
IUPAC, IUPAC_COMPLEMENT = "ACGTRYSWKMBDHVN", "TGCAYRSWMKVHDBN"
MISSING = ["NA", "NAN", ""]
NO_BARCODE = ["NA", "EMPTY", "NONE", "NULL", "CONTROL", "N/A", ""]


def piece(s: Column, start: Column | int, end: Column | int) -> Column:
    """s[start:end] for 0 <= start; empty where end <= start."""
    start, end = (F.lit(x) if isinstance(x, int) else x for x in (start, end))
    return F.when(end > start, F.substring(s, (start + 1).cast("int"), (end - start).cast("int"))).otherwise(F.lit(""))


def upto(n: Column | int, first: int = 1) -> Column:
    """The whole numbers first..n; none where n < first."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.when(n >= first, F.sequence(F.lit(first), n.cast("int"))).otherwise(F.array().cast("array<int>"))


def bases(s: Column) -> Column:
    return F.transform(upto(F.length(s)), lambda i: F.substring(s, i, F.lit(1)))


def reverse_complement(s: Column, mode: str = "mask") -> Column:
    """The reverse complement. What isn't A, C, G, T or N becomes N (mask, mask_upper), stays
    (keep), is complemented as an IUPAC code (iupac) or is an error (strict)."""
    plain = F.reverse(F.translate(s, "ACGTacgt", "TGCAtgca"))
    if mode == "keep":
        return plain
    if mode == "iupac":
        return F.reverse(F.translate(s, IUPAC + IUPAC.lower(), IUPAC_COMPLEMENT + IUPAC_COMPLEMENT.lower()))
    if mode == "strict":
        return F.when(s.rlike("^[ACGTNacgtn]*$"), plain).otherwise(F.raise_error(F.lit("not a DNA sequence")).cast("string"))
    masked = F.regexp_replace(plain, "[^ACGTNacgtn]", "N")
    return F.upper(masked) if mode == "mask_upper" else masked


def hamming(a: Column, b: Column) -> Column:
    """Positions at which equally long strings differ, whatever their case; null for other lengths."""
    x, y = F.upper(a), F.upper(b)
    differ = F.filter(upto(F.length(x)), lambda i: F.substring(x, i, F.lit(1)) != F.substring(y, i, F.lit(1)))
    return F.when(F.length(x) == F.length(y), F.size(differ))


def gc_content(s: Column) -> Column:
    """The share of G and C of all A, C, G and T; 0 if there are none."""
    u = F.upper(s)
    known = F.length(F.regexp_replace(u, "[^ACGT]", ""))
    return F.coalesce(F.try_divide(F.length(F.regexp_replace(u, "[^GC]", "")), known), F.lit(0.0))


def kmers(s: Column, k: int) -> Column:
    """All k-mers in order."""
    return F.transform(upto(F.length(s) - k + 1), lambda i: F.substring(s, i, F.lit(k)))


def kmer_positions(s: Column, kmer: Column, overlap: bool = True) -> Column:
    """Where kmer occurs; without overlap, each next one starts after the one before."""
    found = F.filter(upto(F.length(s) - F.length(kmer), 0), lambda i: F.substring(s, i + 1, F.length(kmer)) == kmer)
    if overlap:
        return found
    after = lambda out: F.coalesce(F.element_at(out, -1) + F.length(kmer), F.lit(0))
    return F.aggregate(found, F.array().cast("array<int>"), lambda out, i: F.when((F.size(out) == 0) | (i >= F.when(F.size(out) > 0, after(out)).otherwise(0)), F.concat(out, F.array(i))).otherwise(out))


def kmers_spanning(s: Column, position: Column, k: int) -> Column:
    """(kmer, start) of every k-mer that covers the position."""
    first, last = F.greatest(F.lit(0), position - (k - 1)), F.least(position, F.length(s) - k)
    starts = F.when(last >= first, F.sequence(first.cast("int"), last.cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(F.substring(s, i + 1, F.lit(k)).alias("kmer"), i.alias("start")))


def edit_kmers(s: Column, positions: Column, k: int) -> Column:
    """Distinct k-mers over any of the positions, and their reverse complements, sorted."""
    own = F.flatten(F.transform(positions, lambda p: F.transform(kmers_spanning(s, p, k), lambda x: x["kmer"])))
    return F.array_sort(F.array_distinct(F.concat(own, F.transform(own, lambda x: reverse_complement(x)))))


def translate_codon(codon: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in sorted(CODONS.items()) for x in kv)), F.upper(codon)), F.lit("X"))


def find_guide(s: Column, guide: Column) -> Column:
    """(position, strand) of a guide on either strand, the given one first; null where there is none."""
    fwd, rev = F.instr(s, guide), F.instr(s, reverse_complement(guide))
    return F.when(fwd > 0, F.struct((fwd - 1).alias("position"), F.lit("+").alias("strand"))).when(rev > 0, F.struct((rev - 1).alias("position"), F.lit("-").alias("strand")))


def cut_site(s: Column, guide: Column, missing: str = "middle") -> Column:
    """Three bases from the PAM end of the guide; without a guide the middle, or null."""
    at = find_guide(s, guide)
    end = F.when(at["strand"] == "+", at["position"] + F.length(guide) - 3).when(at["strand"] == "-", at["position"] + 3)
    return F.coalesce(end, F.floor(F.length(s) / 2).cast("int")) if missing == "middle" else end


def geometry(s: Column, guide: Column, nuclease: str = "cas9") -> Column:
    """(guide_start, strand, pam, pam_start, cleavage): Cas9 has NGG after the guide and cuts 3 before
    it; Cas12a has TTTN before the guide and cuts 18 from the PAM's start. The PAM is as the given strand reads."""
    at = find_guide(s, guide)
    n, pos, plus = F.length(guide), at["position"], at["strand"] == "+"
    if nuclease == "cas9":
        start, cut = F.when(plus, pos + n).otherwise(pos - 3), F.when(plus, pos + n - 3).otherwise(pos + 3)
        size = 3
    else:
        start = F.when(plus, pos - 4).otherwise(pos + n)
        size = 4
        cut = F.when(plus, start + 18).otherwise(start + size - 18)
    raw = F.when(start >= 0, F.substring(s, start + 1, F.lit(size)))
    return F.when(at.isNotNull(), F.struct(pos.alias("guide_start"), at["strand"].alias("strand"), F.upper(raw).alias("pam"), start.alias("pam_start"), cut.alias("cleavage")))


def signature(wt: Column, hdr: Column) -> Column:
    """(position, wt, hdr) wherever two equally long sequences differ; null for other lengths."""
    differ = F.filter(upto(F.length(wt) - 1, 0), lambda i: F.substring(wt, i + 1, F.lit(1)) != F.substring(hdr, i + 1, F.lit(1)))
    rows = F.transform(differ, lambda i: F.struct(i.alias("position"), F.substring(wt, i + 1, F.lit(1)).alias("wt"), F.substring(hdr, i + 1, F.lit(1)).alias("hdr")))
    return F.when(F.length(wt) == F.length(hdr), rows)


def barcoded_template(left: Column, barcode: Column, right: Column) -> Column:
    return F.upper(F.concat(left, barcode, right))


def full_length_hdr(wt: Column, donor: Column, most: int = 20, least: int = 10) -> Column:
    """The donor spliced into the wild type by its ends, of `most` down to `least` bases each; the donor where no anchor is found."""
    sizes = F.sequence(F.lit(most), F.lit(least), F.lit(-1))
    left = F.element_at(F.filter(F.transform(sizes, lambda n: F.instr(wt, F.substring(donor, F.lit(1), n))), lambda p: p > 0), 1)
    right = F.element_at(F.filter(F.transform(sizes, lambda n: F.struct(F.instr(wt, F.right(donor, n)).alias("p"), n.alias("n"))), lambda x: x["p"] > 0), 1)
    end = right["p"] + right["n"]
    spliced = F.concat(piece(wt, F.lit(0), left - 1), donor, F.substring(wt, end, F.length(wt)))
    has = lambda a: F.size(F.filter(F.transform(sizes, a), lambda p: p > 0)) > 0
    both = has(lambda n: F.instr(wt, F.substring(donor, F.lit(1), n))) & has(lambda n: F.instr(wt, F.right(donor, n)))
    return F.when(both & (F.length(donor) >= least), spliced).otherwise(donor)


def apply_variant(wt: Column, position: Column, ref: Column, alt: Column) -> Column:
    return F.concat(piece(wt, F.lit(0), position), alt, F.substring(wt, (position + F.length(ref) + 1).cast("int"), F.length(wt)))


def plasmid_contig(donor: Column, backbone: Column, guide: Column, insert: Column) -> Column:
    return F.upper(F.concat(backbone, guide, insert, donor))


def shifted_contig(plasmid: Column, backbone: Column) -> Column:
    """The circle opened half-way along its backbone of `backbone` bases."""
    half = F.floor(backbone / 2).cast("int")
    return F.concat(F.substring(plasmid, half + 1, F.length(plasmid)), piece(plasmid, F.lit(0), half))


def integrated_contig(extended: Column, donor: Column, segment: Column, strand: Column, arm: int) -> Column:
    """Left flank, donor, segment, donor, right flank; on the minus strand donor and segment are reversed."""
    turned = lambda x: F.when(strand == "-", reverse_complement(x, "iupac")).otherwise(x)
    return F.concat(F.substring(extended, F.lit(1), F.lit(arm)), turned(donor), turned(segment), turned(donor), F.right(extended, F.lit(arm)))


def pair_key(r1: Column, r2: Column) -> Column:
    """The 32-digit key of a read pair."""
    return F.md5(F.concat(r1, F.lit("|"), F.coalesce(r2, F.lit(""))))


def combo_key(guide: Column, donor: Column) -> Column:
    return F.substring(F.md5(F.concat(guide, F.lit("|"), donor)), 1, 12)


def donor_id(donor: Column) -> Column:
    return F.concat(F.lit("donor_"), F.substring(F.md5(donor), 1, 8))


def count_in_name(name: Column) -> Column:
    """The N of `_count=N` in a read name, else 1."""
    return F.coalesce(F.try_element_at(F.regexp_extract_all(name, F.lit(r"_count=(\d+)"), F.lit(1)), F.lit(1)).cast("int"), F.lit(1))


def bio_sample(sample_id: Column, pattern: str, groups: int) -> Column:
    """The groups of a pattern joined by `_`; null without a match."""
    return F.when(sample_id.rlike(pattern), F.concat_ws("_", *(F.regexp_extract(sample_id, pattern, g) for g in range(1, groups + 1))))


def homopolymer(s: Column, position: Column, reach: int = 14) -> Column:
    """The length of the run of one base around a position, up to `reach` either way; 0 outside."""
    run = lambda x: F.length(F.regexp_extract(x, r"^(.)\1*", 0))
    fwd = run(F.substring(s, position + 1, F.lit(reach + 1)))
    back = run(F.reverse(piece(s, F.greatest(F.lit(0), position - reach), position + 1)))
    return F.when((position >= 0) & (position < F.length(s)), fwd + back - 1).otherwise(0)


def mean_quality(quality: Column) -> Column:
    """The mean of Phred+33 qualities; 0 for none."""
    total = F.aggregate(F.transform(bases(quality), lambda c: F.ascii(c) - 33), F.lit(0), lambda a, x: a + x)
    return F.coalesce(F.try_divide(total, F.length(quality)), F.lit(0.0))


def null_if_missing(s: Column) -> Column:
    return F.when(~F.upper(F.trim(s)).isin(MISSING), s)


def valid_barcode(s: Column) -> Column:
    u = F.upper(F.trim(s))
    return F.coalesce(~u.isin(NO_BARCODE) & u.rlike("^[ACGT]+$"), F.lit(False))


def is_dna(s: Column) -> Column:
    """A sequence rather than a path: A, C, G, T, N only and under 1000 long."""
    return s.rlike("^[ACGTacgtNn]+$") & (F.length(s) < 1000)


def neighbours(s: Column) -> Column:
    """All sequences that differ from an upper-case one in one base."""
    at = lambda i, b: F.concat(piece(s, F.lit(0), i - 1), F.lit(b), F.substring(s, i + 1, F.length(s)))
    return F.flatten(F.transform(upto(F.length(s)), lambda i: F.filter(F.array(*(at(i, b) for b in "ACGT")), lambda x: x != s)))
