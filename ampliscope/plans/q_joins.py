"""Joins: manifests, outer and anti joins, intervals, bands, one-off barcodes; donor reads and variants."""

from __future__ import annotations

from pyspark.sql import functions as F

from ampliscope.functions import intervals as I
from ampliscope.operators import collapse, joins, wgs
from ampliscope.plans.base import DNA, dna, query, table, whole


@query("""SELECT '2024-0' || s.s_nationkey % 9 || '_P' || s.s_suppkey % 4 || '_' || o.l_linenumber AS sample_id, 'raw/fastq/2024-0' || s.s_nationkey % 9 || '_P' || s.s_suppkey % 4 || '_' || o.l_linenumber || '_R1.fastq.gz' AS r1_path, o.l_returnflag AS expected_barcode, o.l_suppkey AS "gDNA_plate_num"
  FROM lineitem o JOIN supplier s ON s.s_suppkey = o.l_suppkey WHERE 'L' || o.l_suppkey % 3 = 'L1'""")
def manifest_inner(spark, sf_dir):
    samples = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("gDNA_plate_num"), F.col("l_linenumber").alias("sample_number"), F.col("l_returnflag").alias("barcode"))
    plates = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("gDNA_plate_num"), F.concat(F.lit("L"), F.col("s_suppkey") % 3).alias("locus"), F.concat(F.lit("2024-0"), F.col("s_nationkey") % 9).alias("sequencing_date"), F.concat(F.lit("P"), F.col("s_suppkey") % 4).alias("outer_primers"))
    return joins.manifest(samples, plates, "raw", locus="L1").select("sample_id", "r1_path", "expected_barcode", "gDNA_plate_num")


@query("SELECT coalesce(a.k, b.k) AS sample_id, a.own, b.other FROM (SELECT l_partkey AS k, count(*) AS own FROM lineitem GROUP BY 1) a FULL JOIN (SELECT c_custkey * 2 AS k, round(c_acctbal, 2) AS other FROM customer) b ON a.k = b.k")
def method_full_outer(spark, sf_dir):
    """Whole tables of which each has keys that the other lacks: parts that were sold, and customers under even numbers."""
    own = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("sample_id")).agg(F.count("*").alias("own"))
    other = table(spark, sf_dir, "customer").select((F.col("c_custkey") * 2).alias("sample_id"), F.round("c_acctbal", 2).alias("other"))
    return joins.method_outer(own, other)


@query("SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority, arg_min(CASE WHEN o_orderstatus != 'P' THEN o_orderstatus END, CASE WHEN o_orderstatus != 'P' THEN o_orderkey END) AS status FROM orders GROUP BY o_custkey")
def first_metadata(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumn("status", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    return joins.first_known(rows, "o_custkey", ["o_orderpriority", "status"], F.col("o_orderkey"))


@query("SELECT d.doc_id, d.source, coalesce(CASE WHEN l.toxic = 1 THEN 'HDR' WHEN l.toxic = 0 THEN 'WT' END, 'NOT_IN_CACHE') AS outcome FROM documents d LEFT JOIN labels l USING (doc_id)")
def expand_left(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, "HDR").when(F.col("toxic") == 0, "WT").alias("outcome"))
    return collapse.expand(table(spark, sf_dir, "documents").select("doc_id", "source"), labels, ["doc_id"])


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def semi_relevant(spark, sf_dir):
    return collapse.relevant(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_remaining(spark, sf_dir):
    return collapse.remaining(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")


_READS = "SELECT l_orderkey * 10 + l_linenumber AS id, l_suppkey, l_partkey * 3 AS s, l_partkey * 3 + l_quantity::BIGINT AS e FROM lineitem"
_SPANS = "SELECT p_partkey, p_partkey * 5 AS ws, p_partkey * 5 + p_size AS we FROM part"


@query(f"SELECT r.id, w.p_partkey, r.s, r.e, w.ws, w.we FROM ({_READS}) r JOIN ({_SPANS}) w ON r.s <= w.we AND w.ws <= r.e")
def interval_overlap(spark, sf_dir):
    k = F.col("l_partkey") * 3
    a = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), k.alias("s"), (k + whole("l_quantity")).alias("e"))
    b = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") * 5).alias("ws"), (F.col("p_partkey") * 5 + F.col("p_size")).alias("we"))
    return joins.interval_join(a, b, [], ("s", "e"), ("ws", "we"), 64)


@query(f"SELECT r.id, r.s, EXISTS (SELECT 1 FROM ({_SPANS}) w WHERE w.ws < r.s AND r.s < w.we) AS inside FROM ({_READS}) r")
def point_in_open_interval(spark, sf_dir):
    a = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), (F.col("l_partkey") * 3).alias("s"))
    b = table(spark, sf_dir, "part").select((F.col("p_partkey") * 5).alias("ws"), (F.col("p_partkey") * 5 + F.col("p_size")).alias("we"))
    return joins.in_any(a, b, [], "s", ("ws", "we"), "()", 64)


@query("SELECT a.s_suppkey, b.s_suppkey AS other FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND abs(a.s_suppkey - b.s_suppkey) <= 5")
def band_join(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return joins.band_join(s, s.select(F.col("s_suppkey").alias("other"), "s_nationkey"), ["s_nationkey"], "s_suppkey", "other", 5).select("s_suppkey", "other")


@query(f"SELECT w.p_partkey, w.ws, w.we FROM ({_SPANS}) w WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey * 7 >= w.ws AND o.o_custkey * 7 < w.we)")
def anti_covered(spark, sf_dir):
    w = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") * 5).alias("ws"), (F.col("p_partkey") * 5 + F.col("p_size")).alias("we"))
    return joins.not_covering(w, table(spark, sf_dir, "orders").select((F.col("o_custkey") * 7).alias("p")).distinct(), [], ("ws", "we"), "p", "p_partkey")


#: Ten-base codes of numbers, in base 4.
_CODE = "list_aggregate(list_transform(range(0, 6), lambda i: substr('ACGT', ({0} >> (2 * i)::INT) % 4 + 1, 1)), 'string_agg', '')"


def _code(c):
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.substring(F.lit("ACGT"), (F.call_function("shiftright", c, 2 * i) % 4 + 1).cast("int"), F.lit(1))), "")


@query(f"""WITH rec AS (SELECT {_CODE.format("(p_partkey * 37 % 4096)")} AS bc1, 'o' || p_partkey % 700 AS oligo, sum(p_size)::BIGINT AS support FROM part WHERE p_size >= 3 GROUP BY ALL),
best AS (SELECT bc1, arg_min(oligo, (-support, oligo)) AS oligo, arg_min(support, (-support, oligo)) AS support, count(*) AS oligos FROM rec GROUP BY bc1),
asked AS (SELECT DISTINCT {_CODE.format("(c_custkey * 11 % 4096)")} AS barcode FROM customer),
near AS (SELECT a.barcode, count(*) AS near, min(b.bc1) AS nbc, arg_min(b.oligo, b.bc1) AS noligo, arg_min(b.support, b.bc1) AS nsupport, arg_min(b.oligos, b.bc1) AS noligos FROM asked a JOIN best b ON hamming(a.barcode, b.bc1) = 1 GROUP BY a.barcode),
j AS (SELECT a.barcode, e.oligo, e.support, e.oligos, n.* EXCLUDE (barcode) FROM asked a LEFT JOIN best e ON e.bc1 = a.barcode LEFT JOIN near n ON n.barcode = a.barcode)
SELECT barcode, CASE WHEN oligo IS NOT NULL AND oligos = 1 THEN 'EXACT' WHEN oligo IS NOT NULL THEN 'AMBIGUOUS' WHEN near = 1 AND noligos = 1 THEN 'HD1' WHEN near >= 1 THEN 'AMBIGUOUS' ELSE 'NONE' END AS tier,
  CASE WHEN oligo IS NOT NULL THEN oligo WHEN near = 1 THEN noligo END AS oligo, CASE WHEN oligo IS NOT NULL THEN support WHEN near = 1 THEN nsupport ELSE 0 END AS support, CASE WHEN oligo IS NOT NULL THEN barcode WHEN near = 1 THEN nbc END AS matched, coalesce(oligo IS NOT NULL AND near > 0, false) AS one_off_neighbour FROM j""")
def hamming1_bridge(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(_code(F.col("p_partkey") * 37 % 4096).alias("bc1"), F.concat(F.lit("o"), F.col("p_partkey") % 700).alias("oligo_name"), F.col("p_size").cast("string").alias("count"))
    asked = table(spark, sf_dir, "customer").select(_code(F.col("c_custkey") * 11 % 4096).alias("barcode"))
    return joins.bridge(asked, joins.build_bridge(p, least=3))


_FLAG = "(l_partkey * 7 % 4096)"


@query(f"SELECT l_orderkey, l_linenumber, ({_FLAG} & 4) = 0 AS mapped, ({_FLAG} & 2308) = 0 AS is_primary, ({_FLAG} & 1024) != 0 AS dup, substr(bin({_FLAG}), 11, 1) = '1' AS parity FROM lineitem")
def flag_predicates(spark, sf_dir):
    f = (F.col("l_partkey") * 7 % 4096).cast("int")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", I.mapped(f).alias("mapped"), I.primary(f).alias("is_primary"), I.duplicate(f).alias("dup"), I.duplicate(f, "parity").alias("parity"))


@query("""SELECT l_orderkey, l_linenumber, NOT (e1 < s2 OR s1 > e2) AS overlaps, s1 >= s2 AND e1 <= e2 AS contained, ((s1 < s2 AND e2 < e1) OR (s2 < s1 AND e1 < e2)) AND greatest(e1 - s1, e2 - s2) > least(e1 - s1, e2 - s2) + 20 AS nested
  FROM (SELECT l_orderkey, l_linenumber, l_partkey % 100 AS s1, l_partkey % 100 + l_quantity::BIGINT AS e1, l_suppkey % 100 AS s2, l_suppkey % 100 + 10 AS e2 FROM lineitem)""")
def interval_predicates(spark, sf_dir):
    s1, s2 = F.col("l_partkey") % 100, F.col("l_suppkey") % 100
    e1, e2 = s1 + whole("l_quantity"), s2 + 10
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", I.overlaps(s1, e1, s2, e2).alias("overlaps"), I.contains(s1, e1, s2, e2).alias("contained"), I.nested_gap(s1, e1, s2, e2, 20).alias("nested"))


_REC = """SELECT 'r' || l_orderkey AS read, (CASE WHEN l_linenumber % 4 = 0 THEN 1024 ELSE 0 END)::INT AS flag, 'chr' || l_suppkey % 3 AS chrom, (l_partkey * 17 + l_linenumber * 9)::BIGINT AS pos, CASE l_returnflag WHEN 'A' THEN '5S' || l_quantity::BIGINT || 'M' WHEN 'N' THEN l_quantity::BIGINT || 'M' ELSE l_quantity::BIGINT || 'M4S' END AS cigar, l_quantity::BIGINT AS span,
  CASE l_linenumber % 5 WHEN 1 THEN 'chr9' WHEN 2 THEN '*' ELSE '=' END AS rnext, (l_partkey * 17 + l_linenumber * 5)::BIGINT AS pnext, (l_linenumber * 300 - 400)::BIGINT AS tlen FROM lineitem"""
_WIN = "SELECT 'chr' || p_partkey % 3 AS chrom, (p_partkey * 17)::BIGINT AS ds, (p_partkey * 17 + 59)::BIGINT AS de FROM part"
_BL = "SELECT 'chr9' AS chrom, 100 AS s, 9000 AS e"


@query(f"""WITH x AS (SELECT r.*, w.ds, w.de, r.pos + r.span AS re, CASE WHEN rnext = '=' THEN r.chrom ELSE rnext END AS mate FROM ({_REC}) r JOIN (SELECT DISTINCT * FROM ({_WIN})) w ON r.chrom = w.chrom AND NOT (w.de < r.pos OR w.ds > r.pos + r.span)),
y AS (SELECT *, rnext = '=' AND abs(tlen) < 1000 AS near, least(pos, pnext) >= ds - 6 AND least(pos, pnext) + abs(tlen) - 1 <= de + 6 AS inside, CASE WHEN cigar LIKE '5S%' THEN abs(pos - ds) <= 6 WHEN cigar LIKE '%S' THEN abs(re - de) <= 6 ELSE false END AS junction, pos >= ds - 6 AND re - 1 <= de + 6 AS rin,
  EXISTS (SELECT 1 FROM ({_BL}) b WHERE b.chrom = x.mate AND b.s < x.pnext AND x.pnext < b.e) AS cassette, (flag & 1024) != 0 AS dup FROM x),
k AS (SELECT *, CASE WHEN near THEN CASE WHEN inside THEN 'plasmid' WHEN junction THEN 'chimeric' ELSE 'genome' END WHEN rnext != '*' THEN CASE WHEN cassette THEN CASE WHEN rin THEN 'plasmid' ELSE 'chimeric' END ELSE 'genome' END END AS kind, ((near AND NOT inside) OR (NOT near AND rnext != '*' AND NOT cassette)) AND pos < (ds + de) / 2.0 AND (ds + de) / 2.0 < re AS covers FROM y)
SELECT chrom, ds AS donor_start, de AS donor_end, count(*) FILTER (covers AND NOT dup) AS variant_cov, count(DISTINCT CASE WHEN kind = 'genome' AND NOT dup THEN read END) AS frags_genome, count(DISTINCT CASE WHEN kind = 'plasmid' AND NOT dup THEN read END) AS frags_plasmid, count(DISTINCT CASE WHEN kind = 'chimeric' AND NOT dup THEN read END) AS frags_chimeric FROM k GROUP BY ALL""")
def donor_read_class(spark, sf_dir):
    n, q = F.col("l_linenumber"), whole("l_quantity").cast("string")
    cigar = F.when(F.col("l_returnflag") == "A", F.concat(F.lit("5S"), q, F.lit("M"))).when(F.col("l_returnflag") == "N", F.concat(q, F.lit("M"))).otherwise(F.concat(q, F.lit("M4S")))
    rec = table(spark, sf_dir, "lineitem").select(
        F.lit("s").alias("sample"), F.concat(F.lit("r"), "l_orderkey").alias("read"), F.when(n % 4 == 0, 1024).otherwise(0).alias("flag"), F.concat(F.lit("chr"), F.col("l_suppkey") % 3).alias("rname"), (F.col("l_partkey") * 17 + n * 9).alias("pos"), cigar.alias("cigar"),
        F.when(n % 5 == 1, "chr9").when(n % 5 == 2, "*").otherwise("=").alias("rnext"), (F.col("l_partkey") * 17 + n * 5).alias("pnext"), (n * 300 - 400).alias("tlen"),
    )
    start = F.col("p_partkey") * 17
    win = table(spark, sf_dir, "part").select(F.lit("s").alias("sample"), F.concat(F.lit("chr"), F.col("p_partkey") % 3).alias("chrom"), start.alias("donor_start"), (start + 59).alias("donor_end")).distinct()
    found = wgs.donor_reads(rec, win, spark.createDataFrame([("chr9", 100, 9000)], "chrom string, start int, end int"))
    return wgs.donor_read_counts(found).select("chrom", "donor_start", "donor_end", whole("variant_cov").alias("variant_cov"), "frags_genome", "frags_plasmid", "frags_chimeric")


@query("SELECT p_partkey, CASE WHEN e1 < e2 THEN 'designed' WHEN e3 < e4 THEN 'synthetic_error' ELSE 'spontaneous' END AS bucket, e2 AS before, e1 AS after FROM (SELECT p_partkey, levenshtein(p_name, p_type)::BIGINT AS e1, levenshtein(p_brand, p_type)::BIGINT AS e2, levenshtein(p_name, p_mfgr)::BIGINT AS e3, levenshtein(p_brand, p_mfgr)::BIGINT AS e4 FROM (SELECT *, reverse(p_type) AS p_mfgr FROM part))")
def bucket_variant(spark, sf_dir):
    b = wgs.bucket(F.col("p_name"), F.col("p_brand"), F.col("p_type"), F.reverse("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", b.alias("b")).select("p_partkey", "b.bucket", whole("b.before").alias("before"), whole("b.after").alias("after"))


@query(f"""SELECT sample, count(*) FILTER (start <= 300 AND 300 < "end") AS upstream, count(*) FILTER (start <= 1700 AND 1700 < "end") AS downstream, count(*) FILTER (start <= 300 AND 300 < "end") + count(*) FILTER (start <= 1700 AND 1700 < "end") AS total
  FROM (SELECT l_suppkey AS sample, l_partkey % 2000 AS start, l_partkey % 2000 + l_quantity::BIGINT AS "end" FROM lineitem WHERE l_returnflag = 'A') GROUP BY sample""")
def plasmid_integration(spark, sf_dir):
    s = F.col("l_partkey") % 2000
    reads = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("sample"), F.when(F.col("l_returnflag") == "A", "integrated_plasmid_1").otherwise("chr1").alias("rname"), s.alias("start"), (s + whole("l_quantity")).alias("end"), F.lit(2000).alias("contig_length"))
    return wgs.plasmid_integration(reads, 300).select("sample", *(whole(c).alias(c) for c in ("upstream", "downstream", "total")))


@query(f"SELECT a.doc_id, b.doc_id AS other FROM ({DNA}) a JOIN ({DNA}) b ON a.dna = b.dna AND a.doc_id < b.doc_id AND length(a.dna) > 0")
def equal_reads(spark, sf_dir):
    d = dna(spark, sf_dir).where("length(dna) > 0").select("doc_id", "dna")
    return d.join(d.select(F.col("doc_id").alias("other"), "dna"), "dna").where("doc_id < other").select("doc_id", "other")
