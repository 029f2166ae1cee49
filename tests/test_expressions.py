"""Column expressions: known values, and plain Python as the judge."""

import math
import random

import pytest
from pyspark.sql import functions as F

from ampliscope.functions import cigar as C
from ampliscope.functions import dna as D
from ampliscope.functions import homology as H
from ampliscope.functions import intervals as I
from ampliscope.functions import stats as S
from ampliscope.operators import align


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_reverse_complement(spark):
    r = one(spark, *(D.reverse_complement(F.lit(s), m) for s, m in (("ATCG", "mask"), ("atcg", "mask"), ("AtCg", "mask"), ("AtXg", "mask_upper"), ("AXC", "keep"), ("ACGTRYSWKMBDHVN", "iupac"))))
    assert tuple(r) == ("CGAT", "cgat", "cGaT", "CNAT", "GXT", "NBDHVKMWSRYACGT")
    back = one(spark, D.reverse_complement(D.reverse_complement(F.lit("ACGTRYSWKMBDHVN"), "iupac"), "iupac"))
    assert back[0] == "ACGTRYSWKMBDHVN"
    with pytest.raises(Exception, match="not a DNA"):
        one(spark, D.reverse_complement(F.lit("AXC"), "strict"))


def test_distances(spark):
    r = one(spark, D.hamming(F.lit("ATCG"), F.lit("atgg")), D.hamming(F.lit("AAAA"), F.lit("TTTT")), D.hamming(F.lit("A"), F.lit("AA")), D.hamming(F.lit(""), F.lit("")), D.gc_content(F.lit("GGcN")), D.gc_content(F.lit("")))
    assert tuple(r) == (1, 4, None, 0, 1.0, 0.0)


def test_kmers(spark):
    r = one(spark, D.kmers(F.lit("ACGT"), 3), D.kmers(F.lit("AC"), 3), D.kmer_positions(F.lit("AAAAA"), F.lit("AA")), D.kmer_positions(F.lit("AAAAA"), F.lit("AA"), False), D.edit_kmers(F.lit("AACCGG"), F.array(F.lit(0)), 3))
    assert tuple(r) == (["ACG", "CGT"], [], [0, 1, 2, 3], [0, 2], ["AAC", "GTT"])


def test_codons_and_runs(spark):
    r = one(spark, *(D.translate_codon(F.lit(c)) for c in ("atg", "TAA", "NNN", "TGG")), D.homopolymer(F.lit("ACCCT"), F.lit(2)), D.homopolymer(F.lit("ACCCT"), F.lit(9)))
    assert tuple(r) == ("M", "*", "X", "W", 3, 0)
    assert len(D.CODONS) == 64


def test_signature(spark):
    r = one(spark, D.signature(F.lit("AAACCCGGG"), F.lit("AAATTTGGG")).alias("s"), D.signature(F.lit("A"), F.lit("AA")).alias("n"))
    assert [tuple(x) for x in r.s] == [(3, "C", "T"), (4, "C", "T"), (5, "C", "T")] and r.n is None


def test_variant(spark):
    v = lambda s, p, a, b: D.apply_variant(F.lit(s), F.lit(p), F.lit(a), F.lit(b))
    assert tuple(one(spark, v("AAAAA", 2, "A", "AG"), v("AACAA", 2, "CA", "C"))) == ("AAAGAA", "AACA")


def test_contigs(spark):
    c = lambda strand: D.integrated_contig(F.lit("AAAACCCTTTT"), F.lit("CCC"), F.lit("GG"), F.lit(strand), 4)
    assert tuple(one(spark, c("+"), c("-"))) == ("AAAACCCGGCCCTTTT", "AAAAGGGCCGGGTTTT")


def test_full_length(spark):
    wt = "ACGTTGCAAGGCTATCCGATAGTCCATGGTACCTTAGCGGATTCAGACTTGCCAATCGTGATCTGAACG"
    donor = wt[10:30] + "TTT" + wt[33:55]
    r = one(spark, D.full_length_hdr(F.lit(wt), F.lit(donor)), D.full_length_hdr(F.lit(wt), F.lit("GGGGGGGGGGGGGGGG")))
    assert tuple(r) == (wt[:10] + donor + wt[55:], "GGGGGGGGGGGGGGGG")


def test_geometry(spark):
    s = "TTTTACGTACGTACGTACGTACGTTGGAAAA"
    g = "ACGTACGTACGTACGTACGT"
    r = one(spark, D.geometry(F.lit(s), F.lit(g)).alias("g"), D.cut_site(F.lit(s), F.lit("CCCCCCCC")).alias("m"), D.cut_site(F.lit(s), F.lit("CCCCCCCC"), "null").alias("n"), D.geometry(F.lit(s), F.lit(g), "cas12a").alias("h"))
    assert (r.g.guide_start, r.g.strand, r.g.pam, r.g.cleavage) == (4, "+", "TGG", 21) and r.m == len(s) // 2 and r.n is None
    assert (r.h.pam, r.h.pam_start, r.h.cleavage) == ("TTTT", 0, 18)


def plain_homology(kind, p, s, ref):
    e = p + (len(s) if kind == "deletion" else 0)
    left = max([i for i in range(1, min(len(s), p) + 1) if (s[:i] if kind == "deletion" else s[-i:]) == ref[p - i : p]], default=0)
    right = max([i for i in range(1, min(len(s), len(ref) - e) + 1) if (s[-i:] if kind == "deletion" else s[:i]) == ref[e : e + i]], default=0)
    return left, right


def test_homology(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(300):
        ref = "".join(rng.choice("AC") for _ in range(rng.randint(8, 25)))
        p, n = rng.randint(0, len(ref) - 4), rng.randint(1, 4)
        kind = rng.choice(["deletion", "insertion"])
        s = ref[p : p + n] if kind == "deletion" else "".join(rng.choice("AC") for _ in range(n))
        rows.append((kind, p, s, ref))
    df = spark.createDataFrame(rows, "kind string, p int, s string, ref string")
    h = H.indel_homology(F.col("kind"), F.col("p"), F.col("s"), F.col("ref"))
    r = H.indel_range(F.col("kind"), F.col("p"), F.col("s"), F.col("ref"))
    for x in df.select("*", h.alias("h"), r.alias("r")).collect():
        left, right = plain_homology(x.kind, x.p, x.s, x.ref)
        assert (x.h.left, x.h.right) == (left, right)
        assert (x.r.first, x.r.last) == (x.p - left, x.p + (len(x.s) if x.kind == "deletion" else 0) + right)


def test_junctions(spark):
    r = one(spark, H.junction_overlap(F.lit("ACGTT"), F.lit("GGACG"), F.lit("TTCC")).alias("a"), H.junction_overlap(F.lit(""), F.lit("A"), F.lit("C")).alias("b"), H.junction_mirror(F.lit("ACGGG"), F.lit("TTGCA"), F.lit("CCC")).alias("c"), H.shared_end(F.lit("TTACG"), F.lit("ACGGG")).alias("d"), H.overlap(F.lit("TTACG"), F.lit("ACGGG"), 3).alias("e"), H.overlap(F.lit("TTACG"), F.lit("ACGGG"), 4).alias("f"))
    assert (r.a["left"], r.a["right"], r.a["class"]) == (0, 2, "MMEJ_SHORT")
    assert r.b["class"] == "UNKNOWN" and r.c["left"] == 3 and r.c["class"] == "MMEJ_WEAK" and r.d == "ACG" and r.e and not r.f


def test_merge_and_offset(spark):
    a, b = "ACGTACGTTTGGCCAATTGACCAT", "TTGGCCAATTGACCATGGGGCCCC"
    r = one(spark, H.merge_reads(F.lit(a), F.lit(b), 10).alias("m"), H.merge_reads(F.lit("AAAA"), F.lit("CCCC"), 3).alias("n"), H.best_offset(F.lit("TTTACGTTT"), F.lit("ACG")).alias("o"))
    assert r.m == a + "GGGGCCCC" and r.n == "AAAANNNNNNNNNNCCCC" and (r.o.matches, r.o.offset) == (3, 3)


@pytest.mark.parametrize(("cigar", "span"), [("100M", 100), ("10S90M", 90), ("5H20M5S", 20), ("50M2D48M", 100), ("30M5I30M", 60), ("*", 0), ("20M100N20M", None)])
def test_span(spark, cigar, span):
    assert one(spark, C.span_md(F.lit(cigar)))[0] == span


@pytest.mark.parametrize(("md", "n"), [("100", 0), ("50A50", 1), ("30A20T50", 2), ("50^ATG50", 0), ("30A10^ATG20C40", 2)])
def test_md(spark, md, n):
    assert one(spark, C.md_mismatches(F.lit(md)))[0] == n


def test_operations(spark):
    ref, read = "ACGTACGTAC", "TTACGAACTAC"
    ops = C.operations(F.lit("2S4M1I2D4M"), F.lit(0))
    r = one(spark, ops.alias("o"), C.mismatches(ops, F.lit(read), F.lit(ref)).alias("m"), C.insertions(ops, F.lit(read)).alias("i"), C.deletions(ops, F.lit(ref)).alias("d"), C.query_offset(ops, F.lit(3)).alias("q"), C.query_offset(ops, F.lit(4)).alias("z"), C.text(C.parse(F.lit("2S4M"))).alias("t"), C.parse(F.lit("")).alias("e"))
    assert [tuple(x) for x in r.o] == [("S", 2, 0, 0), ("M", 4, 0, 2), ("I", 1, 4, 6), ("D", 2, 4, 7), ("M", 4, 6, 7)]
    assert [(x.ref, x.base, x.ref_base) for x in r.m] == [(3, "A", "T"), (6, "C", "G")]
    assert [(x.position, x.sequence) for x in r.i] == [(4, "A")] and [(x.position, x.sequence) for x in r.d] == [(4, "AC")]
    assert r.q == 5 and r.z is None and r.t == "2S4M" and r.e is None


def test_penalty(spark):
    r = one(spark, C.penalty(F.lit(True), F.lit(3), F.lit(10)), C.penalty(F.lit(False), F.lit(3), F.lit(10)))
    assert r[0] == 13 and math.isinf(r[1])


def test_duplicate_parity(spark):
    flags = spark.range(4096).select(F.col("id").cast("int").alias("f"))
    r = flags.select(F.sum(I.duplicate(F.col("f"), "parity").cast("int")).alias("p"), F.sum(I.duplicate(F.col("f")).cast("int")).alias("s")).first()
    assert (r.p, r.s) == (1536, 2048)
    got = {x.f: x.d for x in flags.where(F.col("f").isin(1024, 1025, 2050, 4094)).select("f", I.duplicate(F.col("f"), "parity").alias("d")).collect()}
    assert got == {1024: False, 1025: True, 2050: True, 4094: True}


@pytest.mark.parametrize(("a", "want"), [((1000, 5000, 2000, 2100), True), ((1000, 2000, 1500, 2500), False), ((1000, 1500, 1100, 1200), False)])
def test_nested(spark, a, want):
    assert one(spark, I.nested_gap(*(F.lit(x) for x in a)))[0] is want


def test_clips(spark):
    at = lambda start, cigar: I.clipped_at(F.lit(100), F.lit(200), F.lit(start), F.lit(cigar), 6)
    assert tuple(one(spark, at(103, "20S80M"), at(150, "50M20S"), at(150, "80M20S"), at(103, "100M"))) == (True, True, False, False)


def test_statistics(spark):
    assert abs(S.two_sided(2.228139, 10) - 0.05) < 1e-5 and abs(S.two_sided(12.7062, 1) - 0.05) < 1e-5 and S.two_sided(0, 5) == pytest.approx(1)
    assert math.isnan(S.two_sided(float("nan"), 3))
    r = one(spark, *(S.stars(F.lit(p)) for p in (0.0005, 0.003, 0.03, 0.08)), S.stars(F.lit(float("nan"))), S.swap_confidence(F.lit(10.0), F.lit(2.5)), S.quantification_start(F.lit(11), F.lit(20), 10))
    assert tuple(r) == ("***", "**", "*", "ns", "", 0.75, 11)


def test_barcodes_and_names(spark):
    r = one(spark, *(D.valid_barcode(F.lit(x)) for x in ("acgt", "control", "ACGN", "")), D.null_if_missing(F.lit("nan")), D.count_in_name(F.lit("x_count=12")), D.count_in_name(F.lit("x")), D.bio_sample(F.lit("p1_A2_r3"), r"(p\d)_(\w\d)", 2), F.size(D.neighbours(F.lit("ACGTACGTACGTACGTACGT"))), D.mean_quality(F.lit("II")), D.is_dna(F.lit("acgtn")), D.is_dna(F.lit("a/b")))
    assert tuple(r) == (True, False, False, False, None, 12, 1, "p1_A2", 60, 40.0, True, False)


def plain_nw(a, b, m, x, g, local):
    h = [[0 if local else (i + j) * g for j in range(len(b) + 1)] if i == 0 else [0 if local else i * g] + [0] * len(b) for i in range(len(a) + 1)]
    best = 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(h[i - 1][j - 1] + (m if a[i - 1] == b[j - 1] else x), h[i - 1][j] + g, h[i][j - 1] + g, *([0] if local else []))
            best = max(best, h[i][j])
    return best if local else h[-1][-1]


def test_alignment():
    rng = random.Random(7)
    for _ in range(150):
        a, b = ("".join(rng.choice("ACG") for _ in range(rng.randint(1, 14))) for _ in range(2))
        top, low, score = align.needleman_wunsch(a, b)
        assert score == plain_nw(a, b, 2, -1, -2, False) and top.replace("-", "") == a and low.replace("-", "") == b
        assert score == sum(-2 if "-" in (p, q) else 2 if p == q else -1 for p, q in zip(top, low))
        top, low, score, i, j = align.smith_waterman(a, b)
        assert score == plain_nw(a, b, 2, -1, -2, True) and a[i:].startswith(top.replace("-", "")) and b[j:].startswith(low.replace("-", ""))


def test_signatures():
    ref = "ACGTTGCAAGGCTATCCGATAGTCCATGGTACCTTAGCGGATTCAGACTTGCCAATCGTGATCTGAACG"
    donor = ref[10:30] + "T" + ref[31:40] + "CCCC" + ref[40:60]
    s = align.donor_signature(ref, donor)
    assert s.snvs == {30: (ref[30], "T")} and list(s.insertions.values()) == ["CCCC"] and not s.deletions
    assert align.donor_signature(ref, align.reverse_complement(donor)) == s
    merged = align.merge_insertions(align.Signature({}, {5: "A", 9: "C", 30: "G"}, {}), ref)
    assert merged.insertions == {5: "A" + ref[5:9] + "C", 30: "G"}
    assert align.homology_arms(align.Signature({4: ("A", "C")}, {}, {8: "GG"}), 20) == ((0, 4), (10, 20))
    assert align.recommended_k(align.Signature({}, {3: "A" * 7}, {})) == 17
    assert len(align.hdr_variants("AAAA", [(0, "A", "C"), (1, "A", "C"), (2, "A", "C")])) == 7
    assert align.common_substring("xxACGTACGTyy", "zACGTACGTq", 4) == "ACGTACGT" and align.common_substring("AC", "GT", 1) == ""
    arms = "A" * 25, "C" * 25
    assert align.is_barcode_set([arms[0] + b + arms[1] for b in ("GG", "TT")]) and not align.is_barcode_set(["ACGT"])
    assert align.barcode_slots({"x": arms[0] + "GG" + arms[1], "y": arms[0] + "TT" + arms[1]})["y"] == (25, "TT")
