"""Joins, dedup, pooling, whole-genome operators: known values and brute force on small rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from ampliscope.operators import collapse, dedup, detect, joins, outcomes, pool, wgs


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_interval_joins(spark):
    rng = random.Random(3)
    a = [(i, rng.choice("xy"), s := rng.randint(0, 400), s + rng.randint(0, 90)) for i in range(120)]
    b = [(i, rng.choice("xy"), s := rng.randint(0, 400), s + rng.randint(0, 90)) for i in range(80)]
    left = spark.createDataFrame(a, "i long, c string, s long, e long")
    right = spark.createDataFrame(b, "j long, c string, t long, f long")
    got = rows(joins.interval_join(left, right, ["c"], ("s", "e"), ("t", "f"), 50), "i", "j")
    assert got == sorted(((x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3]), key=repr)
    for bounds, test in (("[)", lambda p, s, e: s <= p < e), ("[]", lambda p, s, e: s <= p <= e), ("()", lambda p, s, e: s < p < e)):
        got = rows(joins.point_join(left, right, ["c"], "s", ("t", "f"), bounds, 50), "i", "j")
        assert got == sorted(((x[0], y[0]) for x in a for y in b if x[1] == y[1] and test(x[2], y[2], y[3])), key=repr)
    inside = rows(joins.in_any(left, right, ["c"], "s", ("t", "f")), "i", "inside")
    assert inside == sorted(((x[0], any(x[1] == y[1] and y[2] < x[2] < y[3] for y in b)) for x in a), key=repr)
    band = rows(joins.band_join(left, right, ["c"], "s", "t", 7), "i", "j")
    assert band == sorted(((x[0], y[0]) for x in a for y in b if x[1] == y[1] and abs(x[2] - y[2]) <= 7), key=repr)


def test_bridge(spark):
    index = joins.build_bridge(spark.createDataFrame([("ACGTA", "o1", "100"), ("ACGTA", "o1", "50"), ("ACGTT", "o2", "9"), ("GGGGG", "o3", "4"), ("GGGGG", "o4", "4"), ("CCCCC", "o5", "x"), ("TTTTT", "o6", "3")], "bc1 string, oligo_name string, count string"))
    got = {r.barcode: r for r in joins.bridge(spark.createDataFrame([("acgta",), ("GGGGG",), ("TTTTA",), ("ACGTC",), ("AAAAA",), (None,)], "barcode string"), index).collect()}
    assert (got["ACGTA"].tier, got["ACGTA"].oligo, got["ACGTA"].support, got["ACGTA"].one_off_neighbour) == ("EXACT", "o1", 150, True)
    assert (got["GGGGG"].tier, got["GGGGG"].oligo) == ("AMBIGUOUS", "o3")
    assert (got["TTTTA"].tier, got["TTTTA"].oligo, got["TTTTA"].matched) == ("HD1", "o6", "TTTTT")
    assert got["ACGTC"].tier == "AMBIGUOUS" and got["AAAAA"].tier == "NONE" and len(got) == 5


def test_best_alignments(spark):
    df = spark.createDataFrame([("a", "minimap2", 2.0), ("a", "bwa", 2.0), ("b", "bwa", float("inf")), ("b", "bbmap", 13.0), ("c", "zzz", 1.0)], "read_id string, aligner string, penalty double")
    assert rows(dedup.best_by_penalty(df), "read_id", "aligner") == [("a", "bwa"), ("b", "bbmap"), ("c", "zzz")]


def test_position_dedup(spark):
    df = spark.createDataFrame([(0, 100, 200, "100M"), (1, 100, 200, "100M"), (2, 101, 200, "100M"), (3, 100, 200, "50M2D48M")], "read_idx long, start long, end long, cigar string")
    assert rows(dedup.position_dedup(df.repartition(3)), "read_idx") == [(0,), (2,), (3,)]
    pairs = spark.createDataFrame([(0, 0, 100, 50, 150, "100M", "100M"), (1, 0, 100, 50, 150, "100M", "100M"), (2, 1, 101, 51, 151, "100M", "100M"), (3, None, None, 1, 2, None, "1M"), (4, None, None, 1, 2, None, "1M")], "read_idx long, r1_start int, r1_end int, r2_start int, r2_end int, r1_cigar string, r2_cigar string")
    assert rows(dedup.pair_dedup(pairs), "read_idx") == [(0,), (2,), (3,), (4,)]


def test_clusters(spark):
    rng = random.Random(8)
    at = sorted(rng.sample(range(400), 40))
    got = dict(dedup.cluster_by_gap(spark.createDataFrame([(p,) for p in at], "p int"), [], F.col("p"), 10).select("p", "cluster").collect())
    now = 0
    for p, q in zip(at, at[1:]):
        now += q - p > 10
        assert got[q] == now


def test_fdr(spark):
    df = spark.createDataFrame([(0, 0.01), (1, 0.04), (2, 0.03), (3, 0.5), (4, None)], "i int, p double")
    got = dict(pool.benjamini_hochberg(df, "p").select("i", F.round("p_adjusted", 3)).collect())
    assert got == {0: 0.04, 1: 0.053, 2: 0.053, 3: 0.5, 4: None}


def test_pool(spark):
    df = spark.createDataFrame([("a", 2000, 10.0, "x"), ("a", 3000, 20.0, "y"), ("b", 100, 5.0, "z"), ("b", 4000, 50.0, "w"), ("c", 1, 1.0, "u"), ("c", 2, 3.0, "v"), ("d", 5000, float("nan"), "t")], "s string, n long, pct double, m string").withColumn("i", F.monotonically_increasing_id())
    got = {r.s: r for r in pool.pool(df, "s", "n", ["n"], ["pct"], ["m"], "m").collect()}
    assert {k: r.quality_flag for k, r in got.items()} == {"a": "good", "b": "one_low_read_removed", "c": "all_low_reads", "d": "good"}
    assert (got["a"].pct_mean, got["a"].pct_sem, got["b"].pct_mean, got["b"].n_replicates_used, got["b"].pct_sem, got["d"].pct_mean) == (15.0, 5.0, 50.0, 1, 0.0, None)


def test_comparisons(spark):
    values = {"ctl": [1.0, 2.0, 3.0], "trt": [5.0, 7.0, 9.0], "one": [4.0]}
    rows_ = spark.createDataFrame([(k, v) for k, own in values.items() for v in own], "c string, x double")
    stats = pool.condition_statistics(rows_, "c", "x")
    assert {r.c: (r["std"], r.sem) for r in stats.collect()}["one"] == (0.0, 0.0)
    r = pool.compare(stats, "c", "ctl").collect()
    assert len(r) == 1 and r[0].c == "trt" and r[0].difference == 5.0 and r[0].fold_change == 3.5
    assert r[0].t == pytest.approx(5 / math.sqrt(4 / 3 + 1 / 3)) and r[0].significance == "*"
    # the tail of the density, by the trapezoid rule in tan of the angle
    t, df = r[0].t, r[0].df
    top = math.atan(t / math.sqrt(df))
    step = (math.pi / 2 - top) / 20_000
    tail = sum(math.cos(top + (i + 0.5) * step) ** (df - 1) for i in range(20_000)) * step * math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(math.pi)
    assert r[0].p_value == pytest.approx(2 * tail, rel=1e-5)
    assert pool.significant(pool.compare(stats, "c", "ctl")).count() == 1
    assert pool.group_aggregate(rows_, ["c"], ["x"]).where("c = 'one'").first().x_std is None


def test_bucket_and_precall(spark):
    w = [("s1",), ("s2",), ("s3",), ("s4",), ("s5",)]
    windows = spark.createDataFrame(w, "sample string").withColumns({"chrom": F.lit("c"), "donor_start": F.lit(101), "donor_end": F.lit(110), "donor_wt": F.lit("AAAAATTTTT"), "donor_design": F.lit("AACAATTTTT"), "donor_step2": F.lit("AACAATTGTT")})
    b = lambda v: wgs.bucket(F.lit(v), F.lit("AAAAATTTTT"), F.lit("AACAATTTTT"), F.lit("AACAATTGTT"))
    r = spark.range(1).select(b("AACAATTTTT").alias("a"), b("AAAAATTGTT").alias("b"), b("AAAAATTTTA").alias("c")).first()
    assert (tuple(r.a), r.b.bucket, r.c.bucket) == (("designed", 1, 0), "synthetic_error", "spontaneous")
    vcf = spark.createDataFrame([("s1", "c", 103, "A", "C"), ("s1", "c", 108, "T", "G"), ("s2", "c", 108, "T", "A"), ("s1", "d", 103, "A", "G")], "sample string, chrom string, pos int, ref string, alt string")
    g = [("s3", "c", 100 + i, "A", "<NON_REF>", 9) for i in range(1, 11)] + [("s4", "c", 101 + i, "A", "<NON_REF>", 9) for i in range(5)] + [("s5", "c", 103, "A", "C", 0)]
    gvcf = spark.createDataFrame(g, "sample string, chrom string, pos int, ref string, alt string, depth int")
    got = {r.sample: r for r in wgs.precall(windows, vcf, gvcf).collect()}
    assert got["s1"].editing_outcome == "designed_variant_installed;synthetic_error_installed" and got["s1"].designed == ["c_103_A_to_C"] and got["s1"].synthetic == ["c_108_T_to_G"]
    assert got["s2"].editing_outcome == "unknown;spontaneous_mutations"
    assert got["s3"].editing_outcome == "designed_variant_unedited" and got["s4"].editing_outcome == "unknown"
    assert got["s5"].editing_outcome == "designed_variant_installed" and got["s5"].designed == ["(LC)c_103_A_to_C"]


def test_donor_reads(spark):
    rec = [
        ("plasmid", 0, "chrI", 110, "50M", "=", 120, 60), ("genome", 0, "chrI", 80, "100M", "=", 150, 300), ("clip", 0, "chrI", 102, "10S90M", "=", 250, 400), ("cassette", 0, "chrI", 60, "60M", "chrREDI", 500, 0),
        ("cassette_in", 0, "chrI", 110, "50M", "chrREDI", 500, 0), ("edge", 0, "chrI", 60, "60M", "chrREDI", 1000, 0), ("far", 0, "chrI", 120, "60M", "chrII", 5, 0), ("alone", 0, "chrI", 120, "50M", "*", 0, 0), ("dup", 1024, "chrI", 80, "100M", "=", 150, 300), ("outside", 0, "chrI", 300, "50M", "=", 320, 80),
    ]
    df = spark.createDataFrame([("s", *r) for r in rec], "sample string, read string, flag int, rname string, pos int, cigar string, rnext string, pnext int, tlen int")
    windows = spark.createDataFrame([("s", "chrI", 100, 200)], "sample string, chrom string, donor_start int, donor_end int")
    black = spark.createDataFrame([("chrREDI", 1, 1000)], "chrom string, start int, end int")
    found = wgs.donor_reads(df, windows, black)
    got = {r.read: (r.action, r.kind) for r in found.collect()}
    assert got == {"plasmid": ("discard", "plasmid"), "genome": ("include", "genome"), "clip": ("include", "chimeric"), "cassette": ("include", "chimeric"), "cassette_in": ("discard", "plasmid"), "edge": ("include", "genome"), "far": ("include", "genome"), "alone": ("discard", None), "dup": ("include", "genome")}
    c = wgs.donor_read_counts(found).first()
    assert (c.variant_cov, c.frags_genome, c.frags_plasmid, c.frags_chimeric) == (3, 3, 2, 2)
    assert {r.read for r in wgs.cleaned(df, found).collect()} == {"genome", "clip", "cassette", "edge", "far", "dup", "outside"}


def test_barcodes(spark):
    left, bc, right = "ACGTTGCAAGGCTATCCGAT", "ATAAAAATGTTGCGATATCT", "GGCATCACGGTTTACGAGCT"
    ref = left + "N" * 20 + right
    whole = left + bc + right
    reads = [
        ("s", "r1", 0, "t", 5, f"{len(whole) - 5}M", whole[5:], "=", 30, 40, ref), ("s", "r2", 0, "t", 5, f"{len(whole) - 5}M", whole[5:], "=", 30, 40, ref), ("s", "r3", 0, "t", 25, "20S15M", (left + bc)[20:] + right[:15], "=", 1, -50, ref),
        ("s", "hop", 0, "t", 0, f"{len(whole)}M", left + "T" * 20 + right, "chr2", 30, 0, ref), ("s", "odd", 0, "t", 0, f"{len(whole)}M", left + "C" * 20 + right, "=", 9, 60, ref), ("s2", "x", 0, "t", 0, f"{len(whole)}M", left + "G" * 20 + right, "=", 9, 61, ref),
    ]
    df = spark.createDataFrame(reads, "sample string, qname string, flag int, rname string, start int, cigar string, seq string, rnext string, mate_start int, tlen int, ref_seq string")
    df = df.withColumn("start", F.when(F.col("qname") == "r3", 40).otherwise(F.col("start")))
    tracks = spark.createDataFrame([("genome", "t", 20, 40, False, None, None, None, None)], "track string, rname string, bc_start int, bc_end int, turned boolean, left_lo int, left_hi int, right_lo int, right_hi int")
    found = wgs.extract_barcodes(df, tracks)
    got = {r.qname: r for r in found.collect()}
    assert got["r1"].barcode == bc and got["r3"].barcode == bc and got["r3"].anchor == "right" and got["hop"].is_hop and not got["r1"].is_hop
    index = spark.createDataFrame([(bc, "oligo7", 150)], "bc1 string, oligo string, support long")
    calls = {r["sample"]: r for r in wgs.call_barcodes(found, index, spark.createDataFrame([("s",), ("s2",), ("s3",)], "sample string")).collect()}
    assert (calls["s"].barcode, calls["s"].support, calls["s"].both_anchors, calls["s"].n_distinct, calls["s"].n_contaminant, calls["s"].oligo, calls["s"].confidence) == (bc, 2, True, 2, 1, "oligo7", "high")
    assert (calls["s2"].bridge_tier, calls["s2"].confidence, calls["s3"].track, calls["s3"].confidence) == ("NONE", "low", "none", "none")


def test_weighted_table_with_missing_samples(spark):
    df = spark.createDataFrame([("a", "HDR_COMPLETE", 3), ("a", "LOW_QUALITY", 1)], "sample_id string, outcome string, count long")
    got = {r.sample_id: r for r in outcomes.weighted_table(df, samples=spark.createDataFrame([("a",), ("b",)], "sample_id string")).collect()}
    assert (got["a"].total_reads, got["a"].HDR_pct, got["a"].edited_pct, got["b"].total_reads, got["b"].HDR_pct) == (4, 75.0, 75.0, 0, 0.0)


def test_order_and_partitions_do_not_matter(spark):
    rng = random.Random(4)
    data = [(f"s{rng.randint(0, 3)}", "".join(rng.choice("AC") for _ in range(4)), str(rng.randint(0, 5))) for _ in range(400)]
    a = spark.createDataFrame(data, "s string, q string, umi string")
    b = spark.createDataFrame(rng.sample(data, len(data)), a.schema).repartition(7)
    assert rows(collapse.collapse_umi(a, ["s", "q"]), "*") == rows(collapse.collapse_umi(b, ["s", "q"]), "*")
    twice = collapse.collapse(a.union(a), ["s", "q"]).select("s", "q", (F.col("count") / 2).cast("long").alias("count"))
    assert rows(twice, "s", "q", "count") == rows(collapse.collapse(a, ["s", "q"]), "s", "q", "count")


def test_detection(spark):
    assert detect.protocol("TruSeq", True, True) == detect.Protocol(True, True, True, True, "merged")
    assert detect.protocol("tn5", True, False) == detect.Protocol(False, True, False, False, "paired")
    assert [detect.comparison_mode(False, True), detect.comparison_mode(True, True), detect.comparison_mode(True, False)] == ["single", "merged", "paired"]
    ref = "ACGTTGCAAGGCTATCCGATAGTCCATGGTACCTTAGCGGATTCAGACTTGCCAATCG"
    turned = ref[10:50][::-1].translate(str.maketrans("ACGT", "TGCA"))
    reads = spark.createDataFrame([(0, ref[5:40]), (1, "NNN" + ref[20:45]), (2, turned), (3, "GGGG")], "read_idx long, seq string")
    assert dict(detect.start_positions(reads, ref).select("read_idx", "start").collect()) == {0: 5, 1: 17, 2: 10}


def test_one_sample_t_and_correlation_p(spark):
    from ampliscope.operators import pool

    rows = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 4.1), ("a", 3.0, 5.9), ("a", 4.0, 8.3), ("b", 5.0, 1.0)], "k string, x double, y double")
    got = {r.k: r for r in pool.one_sample_t(rows, ["k"], "x", 1.0).collect()}
    assert abs(got["a"].t - 1.5 / (1.2909944487358056 / 2)) < 1e-12 and abs(got["a"].p_value - 0.1027) < 1e-3 and got["b"].t is None
    r = pool.correlation_test(rows.where("k = 'a'"), "x", "y").first()
    assert r.r > 0.99 and 0 < r.p_value < 0.01


def test_ranks_of_ties_and_families(spark):
    import numpy as np

    from ampliscope.operators import pool

    rng = np.random.default_rng(1)
    p = np.round(rng.random(400), 2)
    rows = [(int(i % 3) if i % 7 else None, float(x) if i % 11 else None) for i, x in enumerate(p)]
    got = pool.benjamini_hochberg(spark.createDataFrame(rows, "k int, p double"), "p", ["k"]).collect()
    assert len(got) == 400
    for k in (0, 1, 2, None):
        own = np.sort([x for a, x in rows if a == k and x is not None])
        raw = own * len(own) / np.arange(1, len(own) + 1)
        want = dict(zip(own, np.minimum(np.minimum.accumulate(raw[::-1])[::-1], 1)))
        for x in want:
            want[x] = min(v for y, v in zip(own, np.minimum(np.minimum.accumulate(raw[::-1])[::-1], 1)) if y == x)
        assert all((r.p is None) == (r.p_adjusted is None) and (r.p is None or abs(r.p_adjusted - want[r.p]) < 1e-12) for r in got if r.k == k)
