"""Files: what is read is what was written, whatever the split; streams agree with batches."""

import gzip

import pytest
from pyspark.sql import functions as F

from ampliscope.operators import collapse
from ampliscope.sources import tables, text
from ampliscope.streaming import incremental


def test_fastq(spark, tmp_path):
    records = [(f"@r{i}{';count=3' if i % 4 == 0 else ';size=2' if i % 4 == 1 else ''}", "ACGT" * (i % 5 + 1), "+", "@" + "I" * (4 * (i % 5 + 1) - 1)) for i in range(500)]
    body = "\n".join(x for r in records for x in r) + "\n"
    (tmp_path / "a.fastq").write_text(body)
    (tmp_path / "b.fastq.gz").write_bytes(gzip.compress(body.encode()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = text.fastq(spark, str(tmp_path)).orderBy("file", "read_idx").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.header, r.seq, r.plus, r.qual) for r in got] == records * 2
    assert [r["count"] for r in got[:4]] == [3, 2, 1, 1] and all(r.valid for r in got)
    assert {r.reads for r in text.count_reads(spark, str(tmp_path)).collect()} == {500}
    capped = text.fastq(spark, str(tmp_path / "a.fastq"), most=6).collect()
    assert sorted(r.read_idx for r in capped) == [0, 1, 2]
    one = text.fastq(spark, str(tmp_path / "a.fastq"))
    pairs = text.fastq_pairs(one, one)
    assert pairs.count() == 500
    with pytest.raises(Exception, match="differ in length"):
        text.fastq_pairs(one, one.where("read_idx < 499")).collect()


def test_fasta(spark, tmp_path):
    (tmp_path / "x.fa").write_text(">one first\nacgt\nACGT\n\n>two\nGG\n")
    got = [(r.ordinal, r.name, r.sequence) for r in text.fasta(spark, str(tmp_path / "x.fa")).orderBy("ordinal").collect()]
    assert got == [(1, "one", "ACGTACGT"), (2, "two", "GG")]
    assert text.first_sequence(spark, str(tmp_path / "x.fa")) == "ACGTACGT"
    assert text.sequence_or_file(spark, "acgtn") == "ACGTN" and text.sequence_or_file(spark, str(tmp_path / "x.fa")) == "ACGTACGT"
    long = spark.createDataFrame([("b", "A" * 170), ("a", "C" * 80)], "name string, sequence string")
    lines = [r.value for r in text.fasta_lines(long, "name", "sequence").collect()]
    assert lines == [">a\n" + "C" * 80, ">b\n" + "A" * 80 + "\n" + "A" * 80 + "\n" + "A" * 10]
    assert text.fastq_lines(long, "name", "sequence").where("value like '@a%'").first().value == "@a\n" + "C" * 80 + "\n+\n" + "I" * 80


def test_sam_and_vcf(spark, tmp_path):
    (tmp_path / "x.sam").write_text("@HD\tVN:1.6\nr1\t99\tchrI\t100\t60\t50M\t=\t200\t150\tACGT\tIIII\tNM:i:2\tMD:Z:10A39\tAS:i:44\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\n")
    a, b = text.sam(spark, str(tmp_path / "x.sam")).orderBy("qname").collect()
    assert (a.flag, a.rname, a.pos, a.cigar, a.pnext, a.tlen, a.nm, a.md, a.score) == (99, "chrI", 100, "50M", 200, 150, 2, "10A39", 44)
    assert (b.flag, b.nm, b.md) == (4, None, None)
    (tmp_path / "x.vcf").write_text("##x\n#CHROM\tPOS\nchrI\t5\t.\tA\tG\t9\tq10\t.\n")
    assert [(r.chrom, r.pos, r.ref, r.alt) for r in text.vcf(spark, str(tmp_path / "x.vcf")).collect()] == [("chrI", 5, "A", "G")]
    (tmp_path / "x.g.vcf").write_text("#h\nchrI\t5\t.\tA\tG,<NON_REF>\t9\t.\t.\tGT:AD:DP\t0/1:7,3:10\nchrI\t6\t.\tA\t<NON_REF>\t9\t.\t.\tGT\t0/0\n")
    assert [(r.pos, r.alt, r.depth) for r in text.gvcf(spark, str(tmp_path / "x.g.vcf")).orderBy("pos").collect()] == [(5, "G", 7), (6, "<NON_REF>", 0)]


def test_tables(spark, tmp_path):
    (tmp_path / "key.tsv").write_text("sample_id\tr1_path\treference\tcondition\treplicate\n007\ta.fq\t\tctl\t1\nx\tNA\tACGT\tnan\t2\nx\tb.fq\t\ttrt\t3\n")
    got = tables.sample_key(spark, str(tmp_path / "key.tsv"))
    first = got.where("sample_id = '007'").first()
    assert first.metadata == {"condition": "ctl", "replicate": "1"} and first.reference is None and first.r2_path is None
    assert {(r.sample_id, r.problem) for r in tables.sample_problems(got).collect()} == {("x", "no r1_path"), ("x", "partial locus"), ("x", "repeated sample_id")}
    (tmp_path / "bad.tsv").write_text("sample_id\nx\n")
    with pytest.raises(ValueError):
        tables.sample_key(spark, str(tmp_path / "bad.tsv"))
    assert tables.sample_key_template(True).startswith("sample_id\tr1_path\tr2_path\treference\thdr_template\tguide")
    (tmp_path / "black.tsv").write_text("chrREDI\t1\t1000\tlabel\nchrX\tfoo\tbar\n")
    assert sorted(map(tuple, tables.blacklist(spark, str(tmp_path / "black.tsv")).collect())) == [("chrREDI", 1, 1000), ("chrX", 0, 0)]
    codes = spark.createDataFrame([("acgt", "1"), ("NA", "2"), ("ACGT", "1"), ("AXG", "3"), (None, "4")], "barcode string, id string")
    assert [tuple(r) for r in tables.barcodes(codes, id_column="id").collect()] == [("1", "ACGT")]
    assert tables.locus_config("a: 'x y'\n# no\nb: \"z\"  # c\n") == {"a": "x y", "b": "z"} and tables.locus("chr1:1,000-2000") == ("chr1", 1000, 2000)
    df = spark.createDataFrame([("a", 1.23456, [1, 2])], "s string, x double, l array<int>")
    tables.write_tsv(tables.formatted(df, {"x": 2}), str(tmp_path / "out"))
    assert [tuple(r) for r in tables.tsv(spark, str(tmp_path / "out")).collect()] == [("a", "1.23", "1,2")]
    assert tables.export_sqlite(df.select("s", F.lit(None).cast("string")), "t").first().value == "INSERT INTO t VALUES ('a', NULL);"
    report = tables.report(spark.createDataFrame([("a", 10, 5.0), ("b", 20, 7.5)], "s string, n long, h double"), "s", "n", "h")
    assert "| b | 7.50 | 20 |" in report and "Reads: 30" in report
    assert tables.report(spark.createDataFrame([], "s string, n long, h double"), "s", "n", "h").endswith("Reads: 0\n")
    assert [r.s for r in tables.page(spark.createDataFrame([(str(i),) for i in range(7)], "s string"), ["s"], 3, 1).collect()] == ["3", "4", "5"]


def test_streams(spark, tmp_path):
    schema = "r1 string, r2 string, sample_id string, guide string, donor string, count long"
    parts = [[("A", "C", "s", "g", "d", 1), ("G", "", "s", "g", "d", 2)], [("A", "C", "t", "g", "d", 5)]]
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for own in parts:
        spark.createDataFrame(own, schema).coalesce(1).write.mode("append").parquet(src)
        q = incremental.upsert_into(incremental.read_stream(spark, src, schema, 1), out, str(tmp_path / "ck"))
        q.awaitTermination(60)
    batch, _ = collapse.global_unique(spark.read.parquet(src))
    assert sorted(map(tuple, incremental.current(spark, out).collect())) == sorted(map(tuple, batch.collect()))


def test_running_outcomes(spark, tmp_path):
    schema = "sample_id string, outcome string, count long"
    src = str(tmp_path / "in")
    df = spark.createDataFrame([("a", "WT", 1), ("a", "WT", 2), ("b", "HDR", 3)], schema)
    df.write.parquet(src)
    q = incremental.running_outcomes(incremental.read_stream(spark, src, schema)).writeStream.outputMode("complete").format("memory").queryName("running").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted(map(tuple, spark.table("running").collect())) == [("a", "WT", 3), ("b", "HDR", 3)]
    q = incremental.first_of_key(incremental.read_stream(spark, src, schema), ["sample_id"]).writeStream.format("memory").queryName("firsts").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("firsts").count() == 2
