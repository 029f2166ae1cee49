"""The read classifiers against a slow plain-Python reading of their rules, on random reads."""

import random

import pytest
from pyspark.sql import functions as F

from ampliscope.operators import align, classify_edit, classify_more

REF = "ACGTTGCAAGGCTATCCGATAGTCCATGGTACCTTAGCGGATTCAGACTTGCCAATCGTGATCTGAACGCTTAGGCATCACGGTTTACGAGCTCATG"
CUT = 45
SIGNATURE = align.Signature({40: (REF[40], "G"), 48: (REF[48], "A" if REF[48] != "A" else "C")}, {44: "TTTTT"}, {52: REF[52:54]})


def homology(kind, p, s):
    e = p + (len(s) if kind == "deletion" else 0)
    left = max([i for i in range(1, min(len(s), p) + 1) if (s[:i] if kind == "deletion" else s[-i:]) == REF[p - i : p]], default=0)
    right = max([i for i in range(1, min(len(s), len(REF) - e) + 1) if (s[-i:] if kind == "deletion" else s[:i]) == REF[e : e + i]], default=0)
    return left, right


def fuzzy(a, b):
    if a == b or a in b or b in a:
        return True
    if len(a) < 5 or len(b) < 5:
        return False
    for o in range(-3, 4):
        x = a[o:] if o >= 0 else a[: len(b) + o]
        y = b[: len(x)] if o >= 0 else b[-o:]
        if len(x) >= min(len(a), len(b)) // 2 and x == y:
            return True
    return False


def judge(read, ops, start):
    edits, ref, q, chimeric = [], start, 0, False
    for n, op in ops:
        if op == "M":
            for i in range(n):
                if q + i < len(read) and ref + i < len(REF) and read[q + i] != REF[ref + i]:
                    p = ref + i
                    edits.append(("snv", p, read[q + i], p in SIGNATURE.snvs and SIGNATURE.snvs[p][1] == read[q + i]))
            ref, q = ref + n, q + n
        elif op == "I":
            s = read[q : q + n]
            chimeric |= n >= 30 and s.count("N") >= 5
            edits.append(("insertion", ref, s, any(abs(ref - p) <= 5 and fuzzy(s, x) for p, x in SIGNATURE.insertions.items())))
            q += n
        elif op == "D":
            s = REF[ref : ref + n]
            edits.append(("deletion", ref, s, SIGNATURE.deletions.get(ref) == s))
            ref += n
        else:
            q += n
    size = sum(1 if k == "snv" else len(s) for k, _, s, _ in edits)
    length = max(len(read), len(REF))
    if (length - size) / length < 0.9 or size / length > 0.15:
        return "LOW_QUALITY"
    if chimeric:
        return "CHIMERIC"
    donor = sum(e[3] for e in edits)
    mmej = nhej = off = 0
    for kind, p, s, own in edits:
        if kind != "snv" and not own:
            left, right = homology(kind, p, s)
            low, high = p - left, p + (len(s) if kind == "deletion" else 0) + right
            if low <= CUT + 1 and high >= CUT - 1:
                mmej, nhej = mmej + (max(left, right) > 2), nhej + (max(left, right) <= 2)
            else:
                off += 1
    near = sum(k == "snv" and not own and abs(p - CUT) <= 50 for k, p, _, own in edits)
    other = len(edits) - donor
    if not edits:
        return "WT"
    if donor and not other:
        return "HDR_COMPLETE" if donor == SIGNATURE.size else "HDR_PARTIAL"
    if donor:
        return "HDR_PLUS_MMEJ_INDEL" if mmej else "HDR_PLUS_NHEJ_INDEL" if nhej else "HDR_PLUS_OTHER" if off or near else "WT"
    return "MMEJ_INDEL" if mmej else "NHEJ_INDEL" if nhej else "NON_DONOR_NON_NHEJ_INDEL" if off else "NON_DONOR_SNV" if near else "WT"


def random_read(rng):
    start = rng.choice([0, 0, 3])
    ops, read, at = [], "", start
    if rng.random() < 0.2:
        ops.append((3, "S"))
        read += "GGG"
    edits = sorted(rng.sample([(40, "x"), (48, "x"), (44, "i"), (52, "d")], rng.randint(0, 4)) + [(rng.randint(start + 4, 80), rng.choice("sidI")) for _ in range(rng.choice([0, 0, 1, 1, 2]))])
    for p, kind in edits:
        if p < at + 1:
            continue
        ops.append((p - at, "M"))
        read += REF[at:p]
        at = p
        if kind == "x" and p in SIGNATURE.snvs:
            read += SIGNATURE.snvs[p][1]
            ops.append((1, "M"))
            at += 1
        elif kind == "s":
            read += rng.choice([b for b in "ACGT" if b != REF[p]])
            ops.append((1, "M"))
            at += 1
        elif kind == "I":
            read += "N" * 6 + "A" * 26
            ops.append((32, "I"))
        elif kind == "i":
            s = SIGNATURE.insertions.get(p) if p in SIGNATURE.insertions and rng.random() < 0.7 else "".join(rng.choice("ACGT") for _ in range(rng.randint(1, 6)))
            read += s
            ops.append((len(s), "I"))
        else:
            n = len(SIGNATURE.deletions[p]) if p in SIGNATURE.deletions and rng.random() < 0.7 else rng.randint(1, 6)
            ops.append((n, "D"))
            at += n
    ops.append((len(REF) - at, "M"))
    return read + REF[at:], ops, start


@pytest.fixture(scope="module")
def reads():
    rng = random.Random(12)
    return [random_read(rng) for _ in range(600)]


def test_edit_outcomes(spark, reads):
    rows = [(str(i), r, "".join(f"{n}{o}" for n, o in ops), start, REF, CUT, "d") for i, (r, ops, start) in enumerate(reads)]
    df = spark.createDataFrame(rows, "seq_hash string, read_seq string, cigar string, ref_start int, ref_seq string, cut_site int, donor_id string")
    signature = spark.createDataFrame(SIGNATURE.rows("d"), align.SIGNATURE_SCHEMA)
    got = {int(r.seq_hash): r for r in classify_edit.classify(df, signature).collect()}
    want = {i: judge(*x) for i, x in enumerate(reads)}
    assert {i: r.outcome for i, r in got.items()} == want
    assert len(set(want.values())) >= 9
    assert all(set(r.donor_snvs_detected) | set(r.donor_snvs_missing) == set(SIGNATURE.snvs) for r in got.values())
    none = classify_edit.classify(df.withColumn("donor_id", F.lit("unknown")), signature).where("outcome like 'HDR%'").count()
    assert none == 0


def test_no_cigar_and_homopolymers(spark):
    df = spark.createDataFrame([("a", REF, None, 0, REF, CUT, "d"), ("b", REF[:10] + REF[11:], "10M1D85M", 0, REF, CUT, "d")], "seq_hash string, read_seq string, cigar string, ref_start int, ref_seq string, cut_site int, donor_id string")
    signature = spark.createDataFrame(SIGNATURE.rows("d"), align.SIGNATURE_SCHEMA)
    off = {r.seq_hash: r.outcome for r in classify_edit.classify(df, signature).collect()}
    on = {r.seq_hash: r.outcome for r in classify_edit.classify(df, signature, classify_edit.Settings(homopolymer=2)).collect()}
    assert off["a"] == on["a"] == "WT" and off["b"] == "NON_DONOR_NON_NHEJ_INDEL" and on["b"] == "WT"


def test_many_donors(spark):
    other = align.Signature({60: (REF[60], "G" if REF[60] != "G" else "A")}, {}, {})
    signature = spark.createDataFrame(SIGNATURE.rows("d") + other.rows("e"), align.SIGNATURE_SCHEMA)
    read = REF[:60] + other.snvs[60][1] + REF[61:]
    df = spark.createDataFrame([("a", read, f"{len(REF)}M", 0, REF, CUT, "d")], "seq_hash string, read_seq string, cigar string, ref_start int, ref_seq string, cut_site int, expected_donor string")
    donors = spark.createDataFrame([("d", 0), ("e", 1)], "donor_id string, ordinal int")
    r = classify_edit.classify_multi(df, signature, donors).first()
    assert (r.best_donor_id, r.outcome, r.score, r.is_sample_swap, r.swap_confidence) == ("e", "HDR_COMPLETE", 30.0, True, 1.0)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_pairs_and_coverage(spark):
    merge = lambda a, b, c, n: one(spark, classify_edit.merge_pair(F.lit(a), F.lit(b), F.array(*map(F.lit, c)).cast("array<int>"), F.lit(n)))
    assert [merge("WT", "NHEJ_INDEL", [], 2), merge("HDR_COMPLETE", "HDR_PARTIAL", [1], 2), merge("HDR_PARTIAL", "HDR_COMPLETE", [1, 2], 2), merge("MMEJ_INDEL", "NHEJ_INDEL", [], 2)] == ["NHEJ_INDEL", "HDR_PARTIAL", "HDR_COMPLETE", "MMEJ_INDEL"]
    cover = lambda a, b: one(spark, classify_edit.coverage(F.array(F.lit(5), F.lit(15)), tuple(map(F.lit, a)), tuple(map(F.lit, b))))
    assert [cover((0, 20), (0, 20)).mode, cover((0, 20), (10, 20)).mode, cover((0, 10), (10, 20)).mode, cover((0, 10), (0, 10)).mode] == ["r1_and_r2", "r1_only", "r1_and_r2", "incomplete"]
    assert cover((0, 10), (0, 10)).uncovered == [15]
    mode = lambda a, b, x, y: one(spark, classify_edit.sequencing_mode(F.lit(a), F.lit(b), F.lit(x), F.lit(y), F.lit(100)))
    assert [mode(True, False, 1, 1), mode(True, True, 120, 130), mode(True, True, 50, 300), mode(True, True, 200, 200)] == ["single_end", "symmetric", "asymmetric", "symmetric"]


def test_kmers(spark):
    df = spark.createDataFrame([("AACGT",), ("GATCC",), ("ACGTGATC",), ("TTTT",), ("TATAAG",), ("TATAGATC",)], "s string")
    flags = classify_more.kmer_flags(df, "s", {"wt": ["ACGT"], "hdr": ["GATC"], "contamination": ["TATA"]})
    got = [r.x for r in flags.select(classify_more.kmer_label(F.col("has_wt"), F.col("has_hdr"), F.col("has_contamination")).alias("x")).collect()]
    assert got == ["WT", "HDR", "AMBIGUOUS", "UNKNOWN", "CONTAMINATION", "HDR"]
    pair = lambda a, b: one(spark, classify_more.kmer_pair_label(F.lit(a), F.lit(b)))
    assert [pair("CONTAMINATION", "WT"), pair("CONTAMINATION", "HDR"), pair("WT", "AMBIGUOUS"), pair("UNKNOWN", "AMBIGUOUS"), pair("UNKNOWN", "UNKNOWN")] == ["CONTAMINATION", "HDR", "WT", "AMBIGUOUS", "UNKNOWN"]
    hits = spark.createDataFrame([("a", "t1", 3), ("a", "t2", 3), ("b", "t1", 2), ("b", "t2", 1), ("c", "t1", 0)], "k string, name string, hits long")
    assert {r.k: r.template for r in classify_more.best_template(hits, "k").collect()} == {"a": "AMBIGUOUS", "b": "t1"}
    sequences = spark.createDataFrame([("x", "WT"), ("y", "UNKNOWN")], "seq_hash string, outcome string")
    out = classify_more.hybrid(sequences.select("seq_hash"), lambda s: s.join(sequences, "seq_hash"), lambda s: s.withColumn("outcome", F.lit("NHEJ")))
    assert {r.seq_hash: (r.outcome, r.stage) for r in out.collect()} == {"x": ("WT", "kmer"), "y": ("NHEJ", "alignment")}


def test_three_aligners(spark):
    rows = [("a", "bwa", 2.0, True, 0, "30M60D40M", 50), ("a", "minimap2", 2.0, True, 0, "10M", 50), ("b", "bwa", 1.0, True, 0, "48M3D40M", 50), ("c", "bbmap", 0.0, True, 0, "90M", 50), ("d", "bwa", 4.0, True, 0, "90M", 50), ("e", "bwa", float("inf"), False, 0, "*", 50), ("f", "bwa", 4.0, True, 0, "50M2I40M", 50)]
    df = spark.createDataFrame(rows, "read_id string, aligner string, penalty double, is_mapped boolean, ref_start int, cigar string, cut_site int")
    got = {r.read_id: r.outcome for r in classify_more.by_three_aligners(df).collect()}
    assert got == {"a": "LARGE_DELETION", "b": "NHEJ_DELETION", "c": "WILD_TYPE", "d": "UNCLASSIFIED", "e": "UNMAPPED", "f": "NHEJ_INSERTION"}
    assert {r.read_id: r.outcome for r in classify_more.by_three_aligners(df, parity=True).collect()}["a"] == "NHEJ_DELETION"


def test_by_signature(spark):
    pairs = "array<struct<pos:int,alt:string>>"
    ref = REF
    snv = ref[:40] + "G" + ref[41:]
    insert = ref[10:42]
    rows = [("wt", ref, f"{len(ref)}M"), ("hdr", snv, f"{len(ref)}M"), ("capture", snv[:47] + insert + snv[47:], f"47M{len(insert)}I{len(ref) - 47}M"), ("nhej", ref[:44] + ref[46:], f"44M2D{len(ref) - 46}M"), ("plus", snv[:44] + snv[46:], f"44M2D{len(ref) - 46}M"), ("snv", ref[:50] + ("A" if ref[50] != "A" else "C") + ref[51:], f"{len(ref)}M"), ("far", ref[:60] + ref[61:], f"60M1D{len(ref) - 61}M")]
    df = spark.createDataFrame(rows, "id string, read_seq string, cigar string").withColumns({"is_mapped": F.col("id") != "none", "ref_start": F.lit(0), "ref_seq": F.lit(ref), "donor_seq": F.lit(ref[5:50]), "cut_site": F.lit(CUT), "signature": F.array(F.struct(F.lit(40).alias("pos"), F.lit("G").alias("alt"))).cast(pairs), "expected_insertions": F.array().cast(pairs)})
    got = {r.id: r.outcome for r in classify_more.by_signature(df).collect()}
    assert got == {"wt": "wt", "hdr": "hdr_complete", "capture": "donor_capture", "nhej": got["nhej"], "plus": got["plus"], "snv": "non_donor_snv", "far": "unclassified"}
    assert got["nhej"] in ("nhej_indel", "mmej_indel") and got["plus"] in ("hdr_plus_nhej_indel", "hdr_plus_mmej_indel")


def test_captured_insertions(spark):
    donor = "CCGATTACAGGTTACGTCCA"
    rows = [("exact", [(44, "GATTACAGGTTA")]), ("rough", [(44, "GATTACAGGTAA")]), ("short", [(44, "GATTAC")]), ("far", [(96, "GATTACAGGTTA")]), ("other", [(44, "TGTGTGTGTGTG")]), ("second", [(40, "TGTGTGTGTGTG"), (46, "GATTACAGGTTA")]), ("none", [])]
    df = spark.createDataFrame(rows, "id string, insertions array<struct<position:int,sequence:string>>").withColumns({"donor_seq": F.lit(donor), "ref_seq": F.lit(REF), "cut_site": F.lit(CUT)})
    got = {r.id: r for r in classify_more.captured_insertion(df).collect()}
    assert {k for k, r in got.items() if r.is_donor_capture} == {"exact", "rough", "second"}
    assert (got["second"].donor_capture_distance, got["exact"].donor_capture_size, got["none"].mmej_class) == (1, 12, "")
    left = max((i for i in range(1, 13) if REF[44 - i : 44] == "GATTACAGGTTA"[:i] and all(REF[44 - j : 44] == "GATTACAGGTTA"[:j] for j in range(1, i))), default=0)
    assert got["exact"].junction_homology_left == left
