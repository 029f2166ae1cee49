"""Further operators over the test tables: reads against a reference, mates, templates, barcodes, roll-ups."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from ampliscope.functions import cigar as C
from ampliscope.functions import dna as D
from ampliscope.functions import homology as H
from ampliscope.functions.stats import quantification_start, stars
from ampliscope.operators import classify_edit, classify_more, collapse, dedup, detect, joins, kmers, outcomes, pool, wgs
from ampliscope.plans.base import DNA, EVENTS, LINES, dna, labelled, lines, query, table, whole

#: A reference and a read that every line item's CIGAR aligns, from its part number on.
REF, READ = "ACGTTGCA" * 20, "ACGATGCATTGACCAG" * 8
#: Two matches of `a` and `c` bases with `b` inserted (A), deleted (N) or clipped (R) between; r and q: where the second begins.
ALIGNED = f"""SELECT *, s + a + CASE WHEN f = 'N' THEN b ELSE 0 END AS r, a + CASE WHEN f = 'N' THEN 0 ELSE b END AS q FROM (SELECT read_id, ordinal::BIGINT AS ordinal, l_suppkey, l_partkey, is_mapped, nm,
  l_quantity::BIGINT AS a, ordinal::BIGINT AS b, l_returnflag AS f, (l_partkey % 30 + 1)::BIGINT AS c, (l_partkey % 20)::BIGINT AS s FROM ({LINES}))"""
_PAIRS = "list_concat(list_transform(range(0, a), lambda i: {'r': s + i, 'q': i}), list_transform(range(0, c), lambda i: {'r': r + i, 'q': q + i}))"
_WRONG = f"list_filter({_PAIRS}, lambda p: substr('{REF}', p.r + 1, 1) != substr('{READ}', p.q + 1, 1))"


def aligned(spark, sf_dir):
    rows = lines(spark, sf_dir).withColumn("s", (F.col("l_partkey") % 20).cast("int"))
    return rows.withColumn("ops", C.operations(F.col("cigar"), F.col("s")))


@query(f"SELECT read_id, ordinal, l_suppkey, len(p) AS n, list_sum(list_transform(p, lambda x: x.r))::BIGINT AS ref_sum, list_sum(list_transform(p, lambda x: x.q))::BIGINT AS query_sum FROM (SELECT *, {_PAIRS} AS p FROM ({ALIGNED}))")
def aligned_pairs(spark, sf_dir):
    total = lambda c: whole(F.aggregate("p", F.lit(0), lambda a, x: a + x[c]))
    rows = aligned(spark, sf_dir).withColumn("p", C.pairs(F.col("ops"), F.lit(READ), F.lit(REF)))
    return rows.select("read_id", whole("ordinal").alias("ordinal"), "l_suppkey", whole(F.size("p")).alias("n"), total("ref").alias("ref_sum"), total("query").alias("query_sum"))


@query(f"SELECT read_id, ordinal, l_suppkey, len(m) AS mismatches, a + c - len(m) AS matches, array_to_string(list_transform(m, lambda p: p.r || ':' || substr('{REF}', p.r + 1, 1) || '>' || substr('{READ}', p.q + 1, 1)), ',') AS signature FROM (SELECT *, {_WRONG} AS m FROM ({ALIGNED}))")
def mismatch_signature(spark, sf_dir):
    rows = aligned(spark, sf_dir).withColumn("m", C.mismatches(F.col("ops"), F.lit(READ), F.lit(REF)))
    n = F.size(C.pairs(F.col("ops"), F.lit(READ), F.lit(REF)))
    return rows.select("read_id", whole("ordinal").alias("ordinal"), "l_suppkey", whole(F.size("m")).alias("mismatches"), whole(n - F.size("m")).alias("matches"), C.mismatch_signature(F.col("m")).alias("signature"))


@query(f"SELECT read_id, ordinal, l_suppkey, m AS mismatches, CASE WHEN is_mapped THEN (m + CASE WHEN f = 'R' THEN b ELSE 0 END)::DOUBLE ELSE 'inf'::DOUBLE END AS penalty, a + c + CASE WHEN f = 'N' THEN b ELSE 0 END AS span FROM (SELECT *, greatest(0, nm - CASE WHEN f != 'R' THEN b ELSE 0 END) AS m FROM ({ALIGNED}))")
def alignment_penalty(spark, sf_dir):
    # without a flag the middle is neither edit nor clip; other flags are an insertion; unknown lengths leave out their operation
    f, b, nm = F.col("l_returnflag"), F.col("ordinal"), F.col("nm")
    op = F.when(f.isNull(), "H").when(f == "N", "D").when(f == "R", "S").otherwise("I")
    middle, known = F.coalesce(F.concat(b, op), F.lit("")), b.isNotNull() | f.isNull() | (f == "R")
    whole_cigar = F.concat(whole(F.rint("l_quantity")), F.lit("M"), F.when(f == "N", F.concat(b, op)).otherwise(middle), F.col("l_partkey") % 30 + 1, F.lit("M"))
    rows = lines(spark, sf_dir).withColumns({"cigar": whole_cigar, "middle": middle}).withColumn("m", C.alignment_mismatches(F.when(known, nm), F.col("middle"), F.lit(None).cast("string")))
    penalty = C.penalty(F.col("is_mapped"), F.col("m"), C.soft_clips(F.col("middle")))
    return rows.select("read_id", whole("ordinal").alias("ordinal"), "l_suppkey", whole("m").alias("mismatches"), penalty.alias("penalty"), whole(C.span_md(F.col("cigar"))).alias("span"))


@query(f"SELECT read_id, ordinal, l_suppkey, CASE WHEN s <= 40 AND 40 < s + a THEN 40 - s WHEN r <= 40 AND 40 < r + c THEN q + 40 - r END AS at FROM ({ALIGNED})")
def query_offset(spark, sf_dir):
    return aligned(spark, sf_dir).select("read_id", whole("ordinal").alias("ordinal"), "l_suppkey", whole(C.query_offset(F.col("ops"), F.lit(40))).alias("at"))


@query(f"""SELECT read_id, ordinal, l_suppkey, (CASE WHEN f IN ('A', 'R') AND a < 5 THEN true WHEN f = 'N' AND a > 0 AND a < 5 THEN true ELSE len(list_filter(m, lambda p: p.q < 5)) > 0 END) AS defect FROM (SELECT *, {_WRONG} AS m FROM ({ALIGNED}))""")
def boundary_defect(spark, sf_dir):
    rows = aligned(spark, sf_dir).withColumn("m", C.mismatches(F.col("ops"), F.lit(READ), F.lit(REF)))
    return rows.select("read_id", whole("ordinal").alias("ordinal"), "l_suppkey", C.boundary_defect(F.col("ops"), F.col("m"), 5, False, F.lit(len(READ))).alias("defect"))


@query(f"SELECT read_id, ordinal, l_suppkey, f = 'N' AND b >= 4 AND NOT (s + a + b < 20 OR s + a > 45) AS deleted, CASE WHEN f = 'N' AND b >= 4 AND NOT (s + a + b < 20 OR s + a > 45) THEN substr('{REF}', s + a + 1, b) END AS lost, CASE WHEN f = 'A' AND b >= 2 THEN substr('{READ}', a + 1, b) END AS gained FROM ({ALIGNED})")
def indels_of_a_region(spark, sf_dir):
    gone, new = C.deletions(F.col("ops"), F.lit(REF), 4, (20, 45)), C.insertions(F.col("ops"), F.lit(READ), 2)
    first = lambda x: F.try_element_at(F.transform(x, lambda o: o["sequence"]), F.lit(1))
    return aligned(spark, sf_dir).select("read_id", whole("ordinal").alias("ordinal"), "l_suppkey", (F.size(gone) > 0).alias("deleted"), first(gone).alias("lost"), first(new).alias("gained"))


@query(f"SELECT read_id, ordinal, l_suppkey, CASE WHEN ordinal % 2 = 0 THEN concat_ws(':', 'P', least(l_partkey, l_suppkey), greatest(l_partkey, l_suppkey), a) ELSE concat_ws(':', 'S', l_partkey, l_partkey + c, cigar) END AS molecule FROM (SELECT x.*, a || 'M' || b || CASE f WHEN 'A' THEN 'I' WHEN 'N' THEN 'D' ELSE 'S' END || c || 'M' AS cigar FROM ({ALIGNED}) x)")
def fragment_key(spark, sf_dir):
    c = F.col("l_partkey") % 30 + 1
    key = dedup.fragment_key(F.col("l_partkey"), F.col("l_suppkey"), -whole("l_quantity"), F.col("l_partkey") + c, F.col("cigar"), F.col("ordinal") % 2 == 0)
    return aligned(spark, sf_dir).select("read_id", whole("ordinal").alias("ordinal"), "l_suppkey", key.alias("molecule"))


@query(f"SELECT read_id, ordinal, l_suppkey, hdr FROM (SELECT read_id, ordinal::BIGINT AS ordinal, l_suppkey, l_discount::DOUBLE AS hdr, row_number() OVER (PARTITION BY read_id ORDER BY l_discount DESC, ordinal * 100000 + l_suppkey) AS n FROM ({LINES})) WHERE n = 1")
def best_of_pair(spark, sf_dir):
    rows = lines(spark, sf_dir).select(F.col("read_id").alias("read_name"), whole("ordinal").alias("ordinal"), "l_suppkey", F.col("l_discount").cast("double").alias("hdr"), (whole("ordinal") * 100_000 + F.col("l_suppkey")).alias("idx"))
    return dedup.best_of_pair(rows, "hdr", order="idx").drop("idx").withColumnRenamed("read_name", "read_id")


_MATES = f"SELECT read_id * 10 + ordinal AS idx, CASE WHEN ordinal < 7 THEN l_partkey % 5 END AS s1, l_suppkey % 3 AS s2, l_returnflag AS c1 FROM ({LINES})"


@query(f"SELECT idx FROM (SELECT idx, s1, row_number() OVER (PARTITION BY s1, s2, c1 ORDER BY idx) AS n FROM ({_MATES})) WHERE s1 IS NULL OR n = 1")
def pair_dedup(spark, sf_dir):
    start, mate = F.when(F.col("ordinal") < 7, F.col("l_partkey") % 5), F.col("l_suppkey") % 3
    rows = lines(spark, sf_dir).select((F.col("read_id") * 10 + F.col("ordinal")).alias("idx"), start.alias("r1_start"), (start + 10).alias("r1_end"), mate.alias("r2_start"), (mate + 10).alias("r2_end"), F.col("l_returnflag").alias("r1_cigar"), F.lit("10M").alias("r2_cigar"))
    return dedup.pair_dedup(rows, "idx").select("idx")


_FLAG = "CASE ordinal % 5 WHEN 0 THEN 67 WHEN 1 THEN 131 WHEN 2 THEN 16 WHEN 3 THEN 321 ELSE 133 END"
_MATE = f"SELECT read_id, ordinal::BIGINT * 10000000000 + l_partkey * 100000 + l_suppkey AS ordinal, {_FLAG} AS flag, l_partkey AS start, l_suppkey % 60 AS mapq, CASE WHEN {_FLAG} & 128 != 0 THEN 2 ELSE 1 END AS mate FROM ({LINES}) WHERE {_FLAG} & 2304 = 0"
_last = lambda c, m: f"arg_max({c}, ordinal) FILTER (mate = {m})"


@query(f"""SELECT read_id AS seq_hash, {_last("start", 1)} AS r1_start, {_last("mapq", 1)} AS r1_mapq, {_last("start", 2)} AS r2_start, {_last("mapq", 2)} AS r2_mapq, arg_max(flag & 2 != 0, ordinal) AS is_proper_pair,
  coalesce({_last("flag", 1)}, 4) & 4 = 0 AS r1_is_mapped, coalesce({_last("flag", 1)}, 4) & 16 != 0 AS r1_is_reverse, coalesce({_last("flag", 2)}, 4) & 4 = 0 AS r2_is_mapped, coalesce({_last("flag", 2)}, 4) & 16 != 0 AS r2_is_reverse FROM ({_MATE}) GROUP BY read_id""")
def flatten_mates(spark, sf_dir):
    n = F.col("ordinal") % 5
    flag = F.when(n == 0, 67).when(n == 1, 131).when(n == 2, 16).when(n == 3, 321).otherwise(133)
    rows = lines(spark, sf_dir).select(F.col("read_id").alias("seq_hash"), flag.alias("flag"), "start", (F.col("start") + 10).alias("end"), "cigar", F.lit("ACGT").alias("seq"), (F.col("l_suppkey") % 60).alias("mapq"), (whole("ordinal") * 10_000_000_000 + F.col("l_partkey") * 100_000 + F.col("l_suppkey")).alias("ordinal"))
    return joins.flatten_mates(rows).drop("r1_end", "r1_cigar", "r1_seq", "r2_end", "r2_cigar", "r2_seq")


@query(f"SELECT read_id, ordinal::BIGINT AS ordinal, l_suppkey, CASE WHEN ordinal % 3 = 0 OR ordinal % 4 = 0 THEN 'single_end' WHEN (x >= 24 AND y >= 24) OR (x >= 200 AND y >= 200) THEN 'symmetric' ELSE 'asymmetric' END AS mode FROM (SELECT *, l_quantity::BIGINT AS x, l_partkey % 60 AS y FROM ({LINES}))")
def sequencing_mode(spark, sf_dir):
    n = F.col("ordinal")
    mode = classify_edit.sequencing_mode(n % 3 != 0, F.when(n % 4 != 0, True), whole("l_quantity"), F.col("l_partkey") % 60, F.lit(20))
    return lines(spark, sf_dir).select("read_id", whole(n).alias("ordinal"), "l_suppkey", mode.alias("mode"))


_POSITIONS = "[10, 20, 35]"


@query(f"""SELECT read_id, ordinal, l_suppkey, CASE WHEN len(gone) > 0 THEN 'incomplete' WHEN len(a) = 3 AND len(b) = 3 THEN 'r1_and_r2' WHEN len(a) = 3 THEN 'r1_only' WHEN len(b) = 3 THEN 'r2_only' ELSE 'r1_and_r2' END AS mode, array_to_string(list_sort(gone), ',') AS uncovered FROM
  (SELECT *, list_filter({_POSITIONS}, lambda p: NOT list_contains(a, p) AND NOT list_contains(b, p)) AS gone FROM (SELECT read_id, ordinal::BIGINT AS ordinal, l_suppkey, list_filter({_POSITIONS}, lambda p: p >= l_partkey % 15 AND p < l_quantity::BIGINT) AS a, list_filter({_POSITIONS}, lambda p: p >= l_suppkey % 40 AND p < 60) AS b FROM ({LINES})))""")
def mate_coverage(spark, sf_dir):
    positions = F.array(*(F.lit(p) for p in (10, 20, 35)))
    found = classify_edit.coverage(positions, (F.col("l_partkey") % 15, whole("l_quantity")), (F.col("l_suppkey") % 40, F.lit(60)))
    rows = lines(spark, sf_dir).withColumn("c", found)
    return rows.select("read_id", whole("ordinal").alias("ordinal"), "l_suppkey", "c.mode", F.array_join(F.transform(F.array_sort("c.uncovered"), lambda x: x.cast("string")), ",").alias("uncovered"))


_NAMES = ["WT", "HDR_COMPLETE", "HDR_PARTIAL", "NHEJ_INDEL", "HDR_PLUS_OTHER"]
_LIST = "[" + ", ".join(f"'{x}'" for x in _NAMES) + "]"
_named = lambda n: f"({_LIST})[{n} % 5 + 1]"


@query(f"""SELECT read_id, ordinal, l_suppkey, len(agreed) AS confirmed, CASE WHEN x = y THEN x WHEN x = 'WT' THEN y WHEN y = 'WT' THEN x WHEN starts_with(x, 'HDR') AND starts_with(y, 'HDR') THEN CASE WHEN len(agreed) = 3 THEN 'HDR_COMPLETE' WHEN len(agreed) > 0 THEN 'HDR_PARTIAL' ELSE x END ELSE x END AS outcome FROM
  (SELECT read_id, ordinal::BIGINT AS ordinal, l_suppkey, {_named("l_partkey")} AS x, {_named("l_suppkey")} AS y, list_filter({_POSITIONS}, lambda p: p < l_quantity::BIGINT AND p > l_partkey % 30) AS agreed FROM ({LINES}))""")
def merge_pair(spark, sf_dir):
    """Labels of two mates merged, with the donor SNVs that both confirm."""
    names, positions = F.array(*(F.lit(x) for x in _NAMES)), F.array(*(F.lit(p) for p in (10, 20, 35)))
    label = lambda c: F.element_at(names, (F.col(c) % 5 + 1).cast("int"))
    one, two = F.filter(positions, lambda p: p < whole("l_quantity")), F.filter(positions, lambda p: p > F.col("l_partkey") % 30)
    rows = lines(spark, sf_dir).withColumn("both", F.array_intersect(one, two))
    return rows.select("read_id", whole("ordinal").alias("ordinal"), "l_suppkey", whole(F.size("both")).alias("confirmed"), classify_edit.merge_pair(label("l_partkey"), label("l_suppkey"), F.col("both"), F.lit(3)).alias("outcome"))


_KMER = ["WT", "HDR", "AMBIGUOUS", "CONTAMINATION", "UNKNOWN"]
_KLIST = "[" + ", ".join(f"'{x}'" for x in _KMER) + "]"


@query(f"SELECT read_id, ordinal, l_suppkey, CASE WHEN list_contains(v, 'CONTAMINATION') AND NOT list_contains(v, 'HDR') THEN 'CONTAMINATION' WHEN list_contains(v, 'HDR') THEN 'HDR' WHEN list_contains(v, 'WT') THEN 'WT' WHEN list_contains(v, 'AMBIGUOUS') THEN 'AMBIGUOUS' ELSE 'UNKNOWN' END AS outcome FROM (SELECT read_id, ordinal::BIGINT AS ordinal, l_suppkey, [({_KLIST})[l_partkey % 5 + 1], ({_KLIST})[l_suppkey % 5 + 1]] AS v FROM ({LINES}))")
def kmer_pair_label(spark, sf_dir):
    names = F.array(*(F.lit(x) for x in _KMER))
    label = lambda c: F.element_at(names, (F.col(c) % 5 + 1).cast("int"))
    return lines(spark, sf_dir).select("read_id", whole("ordinal").alias("ordinal"), "l_suppkey", classify_more.kmer_pair_label(label("l_partkey"), label("l_suppkey")).alias("outcome"))


@query("SELECT l_partkey AS key, CASE WHEN count(*) = 1 THEN min(name) ELSE 'AMBIGUOUS' END AS template, max(hits) AS hits FROM (SELECT *, rank() OVER (PARTITION BY l_partkey ORDER BY hits DESC) AS r FROM (SELECT l_partkey, l_returnflag AS name, count(*) AS hits FROM lineitem GROUP BY ALL)) WHERE r = 1 GROUP BY l_partkey")
def best_template(spark, sf_dir):
    hits = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("key"), F.col("l_returnflag").alias("name")).agg(F.count("*").alias("hits"))
    return classify_more.best_template(hits, "key")


_BY_KMER = "CASE WHEN contains(dna, 'CCCC') AND NOT contains(dna, 'GTG') THEN 'CONTAMINATION' WHEN contains(dna, 'GTG') AND NOT contains(dna, 'ACA') THEN 'HDR' WHEN contains(dna, 'ACA') AND NOT contains(dna, 'GTG') THEN 'WT' WHEN contains(dna, 'ACA') THEN 'AMBIGUOUS' ELSE 'UNKNOWN' END"


@query(f"SELECT doc_id, CASE WHEN k != 'UNKNOWN' THEN k WHEN length(dna) % 2 = 0 THEN 'WT' ELSE 'NHEJ_INDEL' END AS outcome, CASE WHEN k != 'UNKNOWN' THEN 'kmer' ELSE 'alignment' END AS stage FROM (SELECT doc_id, coalesce(dna, '') AS dna, coalesce({_BY_KMER}, 'UNKNOWN') AS k FROM ({DNA}))")
def hybrid(spark, sf_dir):
    """K-mers for every sequence, a second look at what they leave unknown."""
    rows = dna(spark, sf_dir).withColumn("dna", F.coalesce("dna", F.lit("")))
    flags = lambda s: classify_more.kmer_flags(s, "dna", {"wt": ["ACA"], "hdr": ["GTG"], "other": ["CCCC"]})
    by_kmer = lambda s: flags(s).withColumn("outcome", classify_more.kmer_label(F.col("has_wt"), F.col("has_hdr"), F.col("has_other")))
    by_length = lambda s: s.withColumn("outcome", F.when(F.length("dna") % 2 == 0, "WT").otherwise("NHEJ_INDEL"))
    return classify_more.hybrid(rows, by_kmer, by_length, "doc_id")


_wt, _hdr = "GATTACAGGCTTAACCGTACGATCGGATCCATTGCAAGCTTACGTAGCTAGGCTAACTTG", "GATTACAGGCTTAACCGTACGATCGCATCCATTGCTAGCTTACGTAGCTAGGCTAACTTG"
_AT = [i for i, (x, y) in enumerate(zip(_wt, _hdr)) if x != y]
_rc = lambda x: f"reverse(translate({x}, 'ACGT', 'TGCA'))"
_both = lambda s: f"SELECT k FROM ({s}) UNION SELECT {_rc('k')} FROM ({s})"
_over = lambda s: _both(f"SELECT substr('{s}', i::BIGINT + 1, 12) AS k FROM (SELECT unnest({_AT}) AS p) , LATERAL (SELECT unnest(range(greatest(0, p - 11), least(p, {len(_wt)} - 12) + 1)) AS i)")
_every = lambda s: _both(f"SELECT substr('{s}', i::BIGINT + 1, 12) AS k FROM range(0, {len(_wt)} - 11) t(i)")


@query(f"SELECT 'wt' AS name, k AS kmer FROM (({_over(_wt)}) EXCEPT ({_every(_hdr)})) UNION ALL SELECT 'hdr', k FROM (({_over(_hdr)}) EXCEPT ({_every(_wt)}))")
def edit_kmers(spark, sf_dir):
    """K-mers over a template's edits that tell it from the wild type, and the other way round."""
    wt, hdr = kmers.edit_sets(_wt, _hdr, _AT, 12)
    return spark.createDataFrame([("wt", x) for x in sorted(wt)] + [("hdr", x) for x in sorted(hdr)], "name string, kmer string")


_PIECES = f"SELECT doc_id, coalesce(dna, '') AS dna FROM ({DNA})"


def _pieces(spark, sf_dir):
    return dna(spark, sf_dir).select("doc_id", F.coalesce("dna", F.lit("")).alias("dna"))


@query("SELECT p_partkey, upper(substr(p_name, 1, 5) || p_brand || substr(p_name, 6, 5)) AS template FROM part")
def barcoded_template(spark, sf_dir):
    name = F.col("p_name")
    return table(spark, sf_dir, "part").select("p_partkey", D.barcoded_template(F.substring(name, 1, 5), F.col("p_brand"), F.substring(name, 6, 5)).alias("template"))


_SIZES = "range(20, 9, -1)"


@query(f"""SELECT doc_id, CASE WHEN l IS NOT NULL AND e IS NOT NULL AND length(donor) >= 10 THEN substr(dna, 1, l - 1) || donor || substr(dna, e) ELSE donor END AS hdr FROM (SELECT *,
  list_filter(list_transform({_SIZES}, lambda n: strpos(dna, substr(donor, 1, n))), lambda p: p > 0)[1] AS l, list_transform(list_filter({_SIZES}, lambda n: strpos(dna, right(donor, n)) > 0), lambda n: strpos(dna, right(donor, n)) + n)[1] AS e
  FROM (SELECT doc_id, substr(dna, 1, 300) AS dna, substr(dna, 31, 20) || 'TTTT' || substr(dna, 61, 20) AS donor FROM ({_PIECES})))""")
def full_length_hdr(spark, sf_dir):
    rows = _pieces(spark, sf_dir).withColumn("donor", F.concat(F.substring("dna", 31, 20), F.lit("TTTT"), F.substring("dna", 61, 20))).withColumn("dna", F.substring("dna", 1, 300))
    return rows.select("doc_id", D.full_length_hdr(F.col("dna"), F.col("donor")).alias("hdr"))


@query(f"""SELECT doc_id, p AS plasmid, substr(p, 6) || substr(p, 1, 5) AS shifted, substr(dna, 1, 15) || CASE WHEN doc_id % 2 = 0 THEN d || s || d ELSE {_rc('d')} || {_rc('s')} || {_rc('d')} END || right(dna, 15) AS integrated
  FROM (SELECT doc_id, dna, substr(dna, 1, 20) AS d, substr(dna, 21, 30) AS s, upper(substr(dna, 11, 10) || substr(dna, 41, 5) || 'acgt' || substr(dna, 1, 20)) AS p FROM ({_PIECES}))""")
def contigs(spark, sf_dir):
    s = lambda a, n: F.substring("dna", a, n)
    plasmid = D.plasmid_contig(s(1, 20), s(11, 10), s(41, 5), F.lit("acgt"))
    whole_one = D.integrated_contig(F.col("dna"), s(1, 20), s(21, 30), F.when(F.col("doc_id") % 2 == 0, "+").otherwise("-"), 15)
    return _pieces(spark, sf_dir).select("doc_id", plasmid.alias("plasmid"), D.shifted_contig(plasmid, F.lit(10)).alias("shifted"), whole_one.alias("integrated"))


_TWO = f"SELECT doc_id, substr(dna, 1, 60) AS a, substr(dna, 20 + doc_id % 50, 60) AS b FROM ({_PIECES})"


@query(f"SELECT doc_id, len(list_filter(range(10, least(length(a), length(b)) + 1), lambda i: right(a, i) = substr(b, 1, i) OR right(b, i) = substr(a, 1, i))) > 0 AS overlaps FROM ({_TWO})")
def overlap(spark, sf_dir):
    rows = _pieces(spark, sf_dir).select("doc_id", F.substring("dna", 1, 60).alias("a"), F.expr("substring(dna, int(20 + doc_id % 50), 60)").alias("b"))
    return rows.select("doc_id", H.overlap(F.col("a"), F.col("b")).alias("overlaps"))


@query(f"""SELECT doc_id, CASE WHEN n IS NULL THEN a || 'NNNNNNNNNN' || b ELSE a || substr(b, n + 1) END AS merged FROM (SELECT *,
  list_max(list_filter(range(20, least(length(a), length(b)) + 1), lambda i: len(list_filter(range(1, i + 1), lambda k: substr(right(a, i), k, 1) != substr(b, k, 1))) <= i * 0.1::DOUBLE)) AS n FROM ({_TWO}))""")
def merge_reads(spark, sf_dir):
    rows = _pieces(spark, sf_dir).select("doc_id", F.substring("dna", 1, 60).alias("a"), F.expr("substring(dna, int(20 + doc_id % 50), 60)").alias("b"))
    return rows.select("doc_id", H.merge_reads(F.col("a"), F.col("b")).alias("merged"))


@query(f"""SELECT doc_id, (o)[1].m AS matches, (o)[1].at AS "offset", substr(r, 11, greatest(0, least(length(r), 50) - 10)) AS amplicon FROM (SELECT *, list_reverse_sort(list_transform(range(0, length(r) - length(d) + 1),
  lambda x: {{'m': len(list_filter(range(1, length(d) + 1), lambda k: substr(d, k, 1) = substr(r, x + k, 1))), 'back': -x, 'at': x}})) AS o FROM (SELECT doc_id, substr(dna, 1, 50) AS r, substr(dna, 20, 12) AS d FROM ({_PIECES})))""")
def best_offset(spark, sf_dir):
    rows = _pieces(spark, sf_dir).select("doc_id", F.substring("dna", 1, 50).alias("r"), F.substring("dna", 20, 12).alias("d"))
    rows = rows.withColumn("o", H.best_offset(F.col("r"), F.col("d")))
    return rows.select("doc_id", whole("o.matches").alias("matches"), whole("o.offset").alias("offset"), H.amplicon(F.col("r"), F.lit(30), 20).alias("amplicon"))


_REFERENCE = {"click": "PERFECT", "view": "WT", "purchase": "NHEJ", "signup": "IMPERFECT", "error": "LARGE_DEL"}
_CASE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _REFERENCE.items()) + " END"
_TEMPLATED = f"SELECT user_id AS sample_id, {_CASE} AS outcome, 't' || event_id % 3 AS template, (floor(abs(value)) + 1)::BIGINT AS count FROM events"


def _templated(spark, sf_dir):
    names = F.create_map(*(F.lit(x) for kv in _REFERENCE.items() for x in kv))
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("sample_id"), F.element_at(names, F.col("event_type")).alias("outcome"), F.concat(F.lit("t"), F.col("event_id") % 3).alias("template"), (F.floor(F.abs("value")) + 1).cast("long").alias("count"))


@query("SELECT sample_id, sum(count)::BIGINT AS total, " + ", ".join(f"coalesce(sum(count) FILTER (outcome = '{k}'), 0)::BIGINT AS {v}" for k, v in (("WT", "wt"), ("PERFECT", "hdr_perfect"), ("IMPERFECT", "hdr_imperfect"), ("NHEJ", "nhej"), ("LARGE_DEL", "large_deletion"))) + f", coalesce(sum(count) FILTER (outcome IN ('PERFECT', 'IMPERFECT') AND template = 't1'), 0)::BIGINT AS expected_hdr, coalesce(sum(count) FILTER (outcome IN ('PERFECT', 'IMPERFECT')), 0) / sum(count) AS hdr_rate FROM ({_TEMPLATED}) GROUP BY sample_id")
def reference_summary(spark, sf_dir):
    return outcomes.reference_summary(_templated(spark, sf_dir), ["sample_id"], F.lit("t1"))


@query(f"SELECT sample_id, template, outcome, sum(count)::BIGINT AS count FROM ({_TEMPLATED}) GROUP BY ALL")
def reads_by_template(spark, sf_dir):
    return outcomes.by_template(_templated(spark, sf_dir), ["sample_id"])


@query("SELECT l_suppkey, count(*) AS total, " + ", ".join(f"count(*) FILTER (o = '{x}') AS {x.lower()}" for x in _KMER) + f", coalesce(count(*) FILTER (o = 'WT') / nullif(count(*) FILTER (o IN ('WT', 'HDR')), 0), 0) AS wt_rate, coalesce(count(*) FILTER (o = 'HDR') / nullif(count(*) FILTER (o IN ('WT', 'HDR')), 0), 0) AS hdr_rate FROM (SELECT l_suppkey, ({_KLIST})[l_partkey % 5 + 1] AS o FROM lineitem) GROUP BY l_suppkey")
def kmer_rates(spark, sf_dir):
    names = F.array(*(F.lit(x) for x in _KMER))
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.element_at(names, (F.col("l_partkey") % 5 + 1).cast("int")).alias("outcome"))
    return outcomes.kmer_rates(rows, ["l_suppkey"])


@query(f"SELECT sample_id, outcome AS mmej_class, count(*) AS n, sum(count)::DOUBLE / count(*) AS mean_size, sum(event_id % 50)::DOUBLE / count(*) AS mean_distance FROM ({EVENTS}) WHERE value > 20 GROUP BY ALL")
def capture_statistics(spark, sf_dir):
    rows = labelled(spark, sf_dir).select("sample_id", (F.col("value") > 20).alias("is_donor_capture"), F.col("outcome").alias("mmej_class"), F.col("count").alias("donor_capture_size"), (F.col("event_id") % 50).alias("donor_capture_distance"))
    return outcomes.capture_statistics(rows, ["sample_id"])


@query("SELECT o_custkey, (n - u) / n AS duplicate_rate, u / n AS dedup_rate, n / u AS compression FROM (SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderpriority) AS u FROM orders GROUP BY 1)")
def library_rates(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.countDistinct("o_orderpriority").alias("u"))
    return rows.select("o_custkey", *outcomes.library_rates(F.col("n"), F.col("u"), F.col("n") - F.col("u")))


@query(f"SELECT sample_id, event_id, count FROM ({EVENTS}) WHERE count >= 40")
def min_count(spark, sf_dir):
    return collapse.min_count(labelled(spark, sf_dir).select("sample_id", "event_id", "count"), 40)


@query("SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, ceil((l_partkey + l_linenumber) - l_linenumber / 2 - 5)::BIGINT AS start FROM lineitem")
def quantification_window(spark, sf_dir):
    start, n = F.col("l_partkey"), F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", whole(n).alias("l_linenumber"), whole(quantification_start(start, start + n, 10)).alias("start"))


_P = "(p_partkey * 7919 % 1000) / 1000"


@query(f"SELECT p_partkey, CASE WHEN {_P} < 0.001::DOUBLE THEN '***' WHEN {_P} < 0.01::DOUBLE THEN '**' ELSE '*' END AS significance FROM part WHERE p_partkey % 5 > 0 AND {_P} < 0.05::DOUBLE")
def significant(spark, sf_dir):
    p = F.when(F.col("p_partkey") % 5 > 0, F.col("p_partkey") * 7919 % 1000 / 1000)
    return pool.significant(table(spark, sf_dir, "part").select("p_partkey", stars(p).alias("significance")))


_TIERS = ["EXACT", "HAMMING1", "AMBIGUOUS", "NONE"]
_TLIST = "[" + ", ".join(f"'{x}'" for x in _TIERS) + "]"


@query(f"SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CASE WHEN t IN ('NONE', 'AMBIGUOUS') THEN 'low' WHEN l_returnflag = 'A' AND t = 'EXACT' THEN 'high' ELSE 'medium' END AS confidence FROM (SELECT *, ({_TLIST})[l_partkey % 4 + 1] AS t FROM lineitem)")
def combine_confidence(spark, sf_dir):
    tier = F.element_at(F.array(*(F.lit(x) for x in _TIERS)), (F.col("l_partkey") % 4 + 1).cast("int"))
    caller = F.when(F.col("l_returnflag") == "A", "high").otherwise("low")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", whole("l_linenumber").alias("l_linenumber"), wgs.combine_confidence(caller, tier).alias("confidence"))


_SEEN = "SELECT l_suppkey AS sample, CASE WHEN l_returnflag = 'R' THEN 'plasmid' ELSE 'genome' END AS track, CASE WHEN l_partkey % 9 > 0 THEN 'B' || l_partkey % 7 END AS barcode, l_orderkey AS molecule, l_linenumber AS mm, l_linenumber % 2 AS anchor, l_linenumber = 7 AS hop, l_linenumber = 6 AS amp FROM lineitem"


@query(f"""SELECT t.sample, t.track, t.barcode, t.support, t.min_flank_mm, t.both_anchors, t.n_distinct, s.n_reads_seen, s.n_contaminant, s.n_amplicon, CASE WHEN t.both_anchors OR t.support >= 2 THEN 'high' ELSE 'low' END AS caller_confidence FROM
  (SELECT *, row_number() OVER (PARTITION BY sample, track ORDER BY support DESC, min_flank_mm, barcode) AS r, count(*) OVER (PARTITION BY sample, track) AS n_distinct FROM (SELECT sample, track, barcode, count(DISTINCT molecule) AS support, min(mm)::BIGINT AS min_flank_mm, count(DISTINCT anchor) = 2 AS both_anchors FROM ({_SEEN}) WHERE NOT hop AND NOT amp AND barcode IS NOT NULL GROUP BY ALL)) t
  JOIN (SELECT sample, track, count(*) AS n_reads_seen, sum(hop::INT)::BIGINT AS n_contaminant, sum((amp AND NOT hop)::INT)::BIGINT AS n_amplicon FROM ({_SEEN}) GROUP BY ALL) s USING (sample, track) WHERE r = 1""")
def top_barcodes(spark, sf_dir):
    t, n = table(spark, sf_dir, "lineitem"), F.col("l_linenumber")
    rows = t.select(F.col("l_suppkey").alias("sample"), F.when(F.col("l_returnflag") == "R", "plasmid").otherwise("genome").alias("track"), F.when(F.col("l_partkey") % 9 > 0, F.concat(F.lit("B"), F.col("l_partkey") % 7)).alias("barcode"), F.col("l_orderkey").alias("molecule"), whole(n).alias("flank_mismatches"), (n % 2).alias("anchor"), (n == 7).alias("is_hop"), (n == 6).alias("is_amplicon"))
    return wgs.top_barcodes(rows)


@query("""SELECT l.l_suppkey AS sample, l.l_orderkey AS read, l.l_linenumber::BIGINT AS ordinal FROM lineitem l LEFT JOIN (SELECT l_suppkey, l_orderkey, max((l_returnflag = 'N')::INT) AS gone, max((l_returnflag = 'A')::INT) AS kept FROM lineitem WHERE l_linenumber % 2 = 0 GROUP BY ALL) s USING (l_suppkey, l_orderkey) WHERE s.gone IS NULL OR (s.gone = 0 AND s.kept = 1)""")
def cleaned_reads(spark, sf_dir):
    records = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("sample"), F.col("l_orderkey").alias("read"), whole("l_linenumber").alias("ordinal"), "l_returnflag")
    judged = records.where("ordinal % 2 = 0").select("sample", "read", F.when(F.col("l_returnflag") == "A", "include").when(F.col("l_returnflag") == "N", "discard").otherwise("none").alias("action"))
    return wgs.cleaned(records.drop("l_returnflag"), judged)


@query("SELECT s_suppkey, CASE WHEN contains(s_name, '3') THEN '3' WHEN contains(s_name, '7') THEN '7' ELSE '3' END AS pair, CASE WHEN n_nationkey IS NULL THEN 'default' ELSE n_name END AS reference_id FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON s_nationkey = n_nationkey")
def sample_references(spark, sf_dir):
    """The primer pair that a sample's name tells, and its reference or the default."""
    samples = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("sample_id"), joins.primer_pair(F.col("s_name"), ["3", "7"]).alias("pair"))
    references = table(spark, sf_dir, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("sample_id"), F.col("n_name").alias("reference_id"))
    return joins.by_reference(samples, references).drop("sample_id")


@query("SELECT *, CASE WHEN library = 'TruSeq' THEN umi ELSE false END AS dedup, library = 'TruSeq' AND merge AND paired AS collapse, CASE WHEN merge AND paired THEN 'merged' WHEN paired THEN 'paired' ELSE 'single' END AS output FROM (VALUES ('TruSeq'), ('Tn5')) a(library), (VALUES (true), (false)) b(umi), (VALUES (true), (false)) c(merge), (VALUES (true), (false)) d(paired)")
def protocols(spark, sf_dir):
    """How each kind of library is prepared."""
    rows = []
    for library, umi, merge, paired in product(("TruSeq", "Tn5"), (True, False), (True, False), (True, False)):
        p = detect.protocol(library, umi, merge, paired)
        rows.append((library, umi, merge, paired, p.dedup, p.collapse, p.output))
    return spark.createDataFrame(rows, "library string, umi boolean, merge boolean, paired boolean, dedup boolean, collapse boolean, output string")
