"""From FASTQ files to the outcome table, by the library and by its commands."""

import random

import pytest

from ampliscope import cli
from ampliscope.operators import align_reads, joins, kmers
from ampliscope.plans import amplicon
from ampliscope.sources import config, tables

REF = "ACGTTGCAAGGCTATCCGATAGTCCATGGTACCTTAGCGGATTCAGACTTGCCAATCGTGATCTGAACGCTTAGGCATCACGGTTTACGAGCTCATG"
GUIDE = REF[28:48]
HDR = REF[10:40] + "G" + REF[41:47] + "A" + REF[48:80] if REF[40] != "G" and REF[47] != "A" else REF[10:40] + "C" + REF[41:47] + "C" + REF[48:80]


@pytest.fixture
def folder(tmp_path):
    edited = REF[:10] + HDR + REF[80:]
    reads = {"s1": [REF] * 6 + [edited] * 3 + [REF[:44] + REF[47:]] * 1, "s2": [REF] * 2 + ["".join(random.Random(1).choice("ACGT") for _ in REF)] * 2}
    lines = ["sample_id\tr1_path\tcondition"]
    for name, own in reads.items():
        path = tmp_path / f"{name}_R1.fastq"
        path.write_text("".join(f"@{name}{i}\n{s}\n+\n{'I' * len(s)}\n" for i, s in enumerate(own)))
        lines.append(f"{name}\t{path}\tx")
    (tmp_path / "key.tsv").write_text("\n".join([*lines, f"s3\t{tmp_path}/s1_R1.fastq\ty"][:3]) + "\n")
    return tmp_path


def test_run(spark, folder):
    locus = config.Locus("l", REF, {"hdr": HDR}, GUIDE)
    assert (locus.strand, locus.cleavage, locus.guide_start) == ("+", 45, 28) and len(locus.signatures["hdr"].snvs) == 2
    got = {r.sample_id: r for r in amplicon.run(spark, tables.sample_key(spark, str(folder / "key.tsv")), locus).collect()}
    assert (got["s1"].total_reads, got["s1"].WT, got["s1"].HDR_COMPLETE, got["s1"].NHEJ_MMEJ_indel) == (10, 6, 3, 1)
    assert (got["s2"].total_reads, got["s2"].WT) == (4, 2) and got["s2"].HDR_total == 0
    templates = {(r.sample_id, r.template): r.reads for r in amplicon.run_templates(amplicon.read_samples(spark, tables.sample_key(spark, str(folder / "key.tsv"))), locus).collect()}
    assert templates[("s1", "hdr")] == 3 and templates[("s2", "NONE")] == 4


def test_commands(spark, folder, capsys):
    common = ["--reference", REF, "--hdr-template", HDR, "--guide", GUIDE]
    cli.main(["run", "--sample-key", str(folder / "key.tsv"), *common, "--output", str(folder / "out")], spark)
    assert {r.sample_id: r.HDR_COMPLETE for r in tables.tsv(spark, str(folder / "out")).collect()} == {"s1": "3", "s2": "0"}
    cli.main(["aggregate", "--results", str(folder / "out"), "--sample", "sample_id", "--min-reads", "5", "--output", str(folder / "agg")], spark)
    assert {r.sample_id: r.quality_flag for r in tables.tsv(spark, str(folder / "agg")).collect()} == {"s1": "good", "s2": "all_low_reads"}
    cli.main(["info", *common], spark)
    cli.main(["init", "--with-locus"], spark)
    cli.main(["extract-kmers", "--contaminant", "ACGTACGTACGTAAAA", "--reference", REF, "--output", str(folder / "k")], spark)
    said = capsys.readouterr().out
    assert "cut at 45" in said and "hdr_template" in said
    assert spark.read.text(str(folder / "k")).count() == len(kmers.contaminant_only("ACGTACGTACGTAAAA", REF))


def test_place():
    assert align_reads.place(REF[5:60], REF)[1:] == (5, "55M")
    assert align_reads.place(REF[5:30] + REF[36:70], REF)[1:] == (5, "25M6D34M")
    start, cigar = align_reads.place(REF[5:30] + "GATTACA" + REF[30:70], REF)[1:]
    assert start == 5 and cigar.count("I") == 1 and "7I" in cigar


def test_config(spark, tmp_path):
    assert config.yaml("a: 1\nb:\n  c: 'x: y'\n  d: 2.5  # no\n  e:\n    - 1\n    - z\nf: true\n") == {"a": 1, "b": {"c": "x: y", "d": 2.5, "e": [1, "z"]}, "f": True}
    p = config.pipeline(spark, f"locus:\n  name: l\n  reference: {REF}\n  hdr_template: {HDR}\n  guide: {GUIDE}\noutput_dir: out\n")
    assert p.locus.cleavage == 45 and p.output == "out" and p.samples is None
    with pytest.raises(ValueError):
        config.Locus("l", REF, {}, "GGGGGGGGGGGGGGGG")
    config.check_track("ACGT" + "N" * 5 + "TTTT", 4, 9, "CGT", "TT")
    for bad in ((3, 9, "ACG", "TT"), (4, 9, "AAA", "TT")):
        with pytest.raises(ValueError):
            config.check_track("ACGT" + "N" * 5 + "TTTT", *bad)
    t = config.tracks(spark, {"barcode_locus": "chrI:11-30", "plasmid_bc_locus": "p:1-20"}, (1, 5)).orderBy("track").collect()
    assert [(r.track, r.bc_start, r.bc_end, r.turned, r.left_lo) for r in t] == [("genome", 10, 30, True, 1), ("plasmid", 0, 20, False, None)]
    s = spark.createDataFrame([("a", "r1", None, "ACGT"), ("b", "r2", None, None)], "sample_id string, r1_path string, r2_path string, amplicon_seq string")
    assert [r.amplicon_seq for r in config.batch_settings(s, "TTTT", "GG").collect()] == ["ACGT", "TTTT"]


def test_templates_and_mates(spark):
    k, sets = kmers.template_sets(REF, {"a": REF[:40] + "G" + REF[41:], "b": REF[:60] + "T" + REF[61:]}, {"a": [40], "b": [60]}, 8)
    assert k == 8 and sets["a"] and sets["b"] and not sets["a"] & sets["b"] and kmers.shared({"x": {"A"}, "y": {"A", "C"}}) == 1
    rows = [("h", 99, 0, 10, "10M", "ACGT", 60, 0), ("h", 147, 20, 30, "9M", "GG", 50, 1), ("h", 2147, 5, 6, "1M", "T", 1, 2), ("g", 4, None, None, "*", "A", 0, 3)]
    df = spark.createDataFrame(rows, "seq_hash string, flag int, start int, end int, cigar string, seq string, mapq int, ordinal int")
    got = {r.seq_hash: r for r in joins.flatten_mates(df).collect()}
    assert (got["h"].r1_cigar, got["h"].r2_cigar, got["h"].is_proper_pair, got["h"].r2_is_reverse) == ("10M", "9M", True, True)
    assert not got["g"].r1_is_mapped and not got["g"].r2_is_mapped


def test_files_of_one_name_stay_apart(spark, tmp_path):
    for folder, seq in (("a", "ACGT"), ("b", "TTTT")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "r1.fastq").write_text(f"@x\n{seq}\n+\nIIII\n" * 2)
    rows = [("A", str(tmp_path / "a" / "r1.fastq")), ("B", str(tmp_path / "b" / "r1.fastq")), ("C", str(tmp_path / "b" / "r1.fastq"))]
    found = amplicon.read_samples(spark, spark.createDataFrame(rows, "sample_id string, r1_path string"))
    assert sorted((r.sample_id, r.sequence, r["count"]) for r in found.collect()) == [("A", "ACGT", 2), ("B", "TTTT", 2), ("C", "TTTT", 2)]
