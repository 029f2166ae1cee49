"""Read classifiers over alignments made from line items: a fixed reference, edited by what a line says."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ampliscope.functions.dna import piece
from ampliscope.operators import align, classify_edit, classify_more, outcomes
from ampliscope.plans.base import LINES, lines, query, table, whole
from ampliscope.plans.q_collapse import _table_sql

#: A reference of 120 bases in which no five repeat, its donor (three SNVs and a deletion) and cut site.
REF = "ACGTTGCAAGGCTATCCGATAGTCCATGGTACCTTAGCGGATTCAGACTTGCCAATCGTGATCTGAACGCTTAGGCATCACGGTTTACGAGCTCATGCTAGGATTGACCGTAAGTCAGCTT"
CUT = 60
DONOR = REF[20:50] + "G" + REF[51:57] + "TT" + REF[59:64] + REF[67:100]
SIGNATURE = align.donor_signature(REF, DONOR)


def reads(spark, sf_dir):
    """A read for each distinct (kind, place, length) of lines: unedited, an SNV, a deletion, an insertion, or donor-like."""
    t = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 5).cast("int").alias("kind"), (F.col("l_suppkey") % 40 + 40).cast("int").alias("at"), (F.col("l_linenumber") % 7 + 1).cast("int").alias("n"))
    t = t.groupBy("kind", "at", "n").agg(F.count("*").alias("count"))
    ref = F.lit(REF)
    at, n, kind = F.col("at"), F.col("n"), F.col("kind")
    head, tail = piece(ref, F.lit(0), at), piece(ref, at, F.lit(len(REF)))
    snv = F.concat(head, F.translate(F.substring(ref, at + 1, F.lit(1)), "ACGT", "CATG"), F.substring(ref, at + 2, F.lit(len(REF))))
    seq = F.when(kind == 0, ref).when(kind == 1, snv).when(kind == 2, F.concat(head, F.substring(ref, at + n + 1, F.lit(len(REF))))).when(kind == 3, F.concat(head, F.substring(F.lit("GATTACA"), F.lit(1), n), tail)).otherwise(F.lit(REF[:20] + DONOR + REF[100:]))
    m = lambda x: F.concat(x.cast("string"), F.lit("M"))
    full = F.lit(len(REF))
    cigar = F.when(kind.isin(0, 1), m(full)).when(kind == 2, F.concat(m(at), n, F.lit("D"), m(full - at - n))).when(kind == 3, F.concat(m(at), n, F.lit("I"), m(full - at))).otherwise(F.lit(_DONOR_CIGAR))
    return t.select(F.md5(F.concat_ws("|", "kind", "at", "n")).alias("seq_hash"), "kind", "at", "n", "count", seq.alias("read_seq"), cigar.alias("cigar"), F.lit(0).alias("ref_start"), ref.alias("ref_seq"), F.lit(CUT).alias("cut_site"))


def _signature(spark):
    return spark.createDataFrame(SIGNATURE.rows("d1"), align.SIGNATURE_SCHEMA)


_done = sorted(SIGNATURE.deletions.items())
_DONOR_CIGAR = f"{_done[0][0]}M{len(_done[0][1])}D{len(REF) - _done[0][0] - len(_done[0][1])}M" if _done else f"{len(REF)}M"
_N = len(REF)
#: The reads above.
READS = re.sub(r"(?<![\w\"])at(?![\w\"])", '"at"', f"""SELECT md5(kind || '|' || at || '|' || n) AS seq_hash, *, CASE kind WHEN 0 THEN '{REF}' WHEN 1 THEN left('{REF}', at) || translate(substr('{REF}', at + 1, 1), 'ACGT', 'CATG') || substr('{REF}', at + 2) WHEN 2 THEN left('{REF}', at) || substr('{REF}', at + n + 1)
    WHEN 3 THEN left('{REF}', at) || left('GATTACA', n) || substr('{REF}', at + 1) ELSE '{REF[:20] + DONOR + REF[100:]}' END AS read_seq,
  CASE kind WHEN 2 THEN at || 'M' || n || 'D' || ({_N} - at - n) || 'M' WHEN 3 THEN at || 'M' || n || 'I' || ({_N} - at) || 'M' WHEN 4 THEN '{_DONOR_CIGAR}' ELSE '{_N}M' END AS cigar
  FROM (SELECT (l_partkey % 5)::INT AS kind, (l_suppkey % 40 + 40)::INT AS "at", (l_linenumber % 7 + 1)::INT AS n, count(*) AS count FROM lineitem GROUP BY ALL)""")
_signature_rows = ", ".join(f"('{kind}', {pos}, '{alt if kind != 'deletion' else ref}')" for _, kind, pos, ref, alt in SIGNATURE.rows("d1"))


def _homology(side: str) -> str:
    """SQL for the left or right homology of an edit (kind, p, s)."""
    end = "(p + CASE kind WHEN 'deletion' THEN length(s) ELSE 0 END)"
    if side == "left":
        return f"coalesce(list_max(list_filter(range(1, least(length(s), p) + 1), lambda i: CASE kind WHEN 'deletion' THEN left(s, i) ELSE right(s, i) END = substr('{REF}', (p - i + 1)::BIGINT, i))), 0)"
    return f"coalesce(list_max(list_filter(range(1, least(length(s), {_N} - {end}) + 1), lambda i: CASE kind WHEN 'deletion' THEN right(s, i) ELSE left(s, i) END = substr('{REF}', ({end} + 1)::BIGINT, i))), 0)"


EDIT_SQL = f"""
WITH reads AS ({READS}), sig(kind, pos, s) AS (VALUES {_signature_rows}),
ops AS (SELECT seq_hash, read_seq, k, substr(o, -1) AS op, regexp_extract(o, '\\d+')::INT AS len FROM (SELECT seq_hash, read_seq, unnest(regexp_extract_all(cigar, '\\d+[MIDS]')) AS o, generate_subscripts(regexp_extract_all(cigar, '\\d+[MIDS]'), 1) AS k FROM reads)),
placed AS (SELECT *, coalesce(sum(CASE WHEN op IN ('M', 'D') THEN len END) OVER w, 0)::BIGINT AS r, coalesce(sum(CASE WHEN op IN ('M', 'I', 'S') THEN len END) OVER w, 0)::BIGINT AS q FROM ops WINDOW w AS (PARTITION BY seq_hash ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
edits AS (SELECT seq_hash, 'snv' AS kind, r + i AS p, substr(read_seq, q + i + 1, 1) AS s FROM (SELECT *, unnest(range(0, len)) AS i FROM placed WHERE op = 'M') WHERE substr(read_seq, q + i + 1, 1) != substr('{REF}', r + i + 1, 1)
  UNION ALL SELECT seq_hash, 'insertion', r, substr(read_seq, q + 1, len) FROM placed WHERE op = 'I' UNION ALL SELECT seq_hash, 'deletion', r, substr('{REF}', r + 1, len) FROM placed WHERE op = 'D'),
own AS (SELECT e.*, EXISTS (SELECT 1 FROM sig d WHERE d.kind = e.kind AND d.s = e.s AND d.pos = e.p) AS donor, CASE WHEN kind = 'snv' THEN 0 ELSE {_homology("left")} END AS hl, CASE WHEN kind = 'snv' THEN 0 ELSE {_homology("right")} END AS hr FROM edits e),
judged AS (SELECT *, kind != 'snv' AND NOT donor AS indel, p - hl <= {CUT} + 1 AND p + CASE kind WHEN 'deletion' THEN length(s) ELSE 0 END + hr >= {CUT} - 1 AS at_cut, greatest(hl, hr) > 2 AS mmej FROM own),
counted AS (SELECT seq_hash, count(*) AS n_edits, count(*) FILTER (donor) AS n_donor, count(*) FILTER (indel AND at_cut AND mmej) AS n_mmej, count(*) FILTER (indel AND at_cut AND NOT mmej) AS n_nhej, count(*) FILTER (indel AND NOT at_cut) AS n_off_cut, count(*) FILTER (kind = 'snv' AND NOT donor AND abs(p - {CUT}) <= 50) AS n_near_snv, sum(length(s)) AS size FROM judged GROUP BY seq_hash),
rows AS (SELECT r.seq_hash, r.kind, r."at", r.n, r.count, greatest(length(r.read_seq), {_N}) AS len, coalesce(c.n_edits, 0) AS n_edits, coalesce(c.n_donor, 0) AS n_donor, coalesce(c.n_mmej, 0) AS n_mmej, coalesce(c.n_nhej, 0) AS n_nhej, coalesce(c.n_off_cut, 0) AS n_off_cut, coalesce(c.n_near_snv, 0) AS n_near_snv, coalesce(c.size, 0) AS size FROM reads r LEFT JOIN counted c USING (seq_hash))
SELECT seq_hash, kind, "at", n, count, CASE WHEN (len - size) / len < 0.9 OR size / len > 0.15 THEN 'LOW_QUALITY' WHEN n_edits = 0 THEN 'WT' WHEN n_donor = {SIGNATURE.size} AND n_edits = n_donor THEN 'HDR_COMPLETE' WHEN n_donor > 0 AND n_edits = n_donor THEN 'HDR_PARTIAL'
    WHEN n_donor > 0 AND n_mmej > 0 THEN 'HDR_PLUS_MMEJ_INDEL' WHEN n_donor > 0 AND n_nhej > 0 THEN 'HDR_PLUS_NHEJ_INDEL' WHEN n_donor > 0 AND (n_off_cut > 0 OR n_near_snv > 0) THEN 'HDR_PLUS_OTHER' WHEN n_donor > 0 THEN 'WT' WHEN n_mmej > 0 THEN 'MMEJ_INDEL' WHEN n_nhej > 0 THEN 'NHEJ_INDEL'
    WHEN n_off_cut > 0 THEN 'NON_DONOR_NON_NHEJ_INDEL' WHEN n_near_snv > 0 THEN 'NON_DONOR_SNV' ELSE 'WT' END AS outcome, n_edits, n_donor, n_edits - n_donor AS n_non_donor, n_mmej, n_nhej, n_off_cut, n_near_snv, round(CASE WHEN n_edits > 0 THEN n_donor / n_edits ELSE 0.0 END, 6) AS donor_fraction FROM rows"""
_THREE = f"""SELECT read_id, aligner, penalty, CASE WHEN NOT is_mapped THEN 'UNMAPPED' WHEN l_returnflag = 'A' AND p <= 32 AND p >= 8 THEN 'NHEJ_INSERTION' WHEN l_returnflag = 'N' AND ordinal >= 6 AND p <= 20 AND p + ordinal >= 20 AND p >= 5 AND l_partkey % 30 + 1 >= 5 THEN 'LARGE_DELETION'
  WHEN l_returnflag = 'N' AND p <= 32 AND p + ordinal >= 8 THEN 'NHEJ_DELETION' WHEN penalty = 0 THEN 'WILD_TYPE' ELSE 'UNCLASSIFIED' END AS outcome FROM (SELECT *, l_quantity::BIGINT AS p, row_number() OVER (PARTITION BY read_id ORDER BY penalty, CASE aligner WHEN 'bwa' THEN 0 WHEN 'bbmap' THEN 1 WHEN 'minimap2' THEN 2 ELSE 99 END, aligner, cigar, is_mapped) AS rn FROM ({LINES})) WHERE rn = 1"""
_detected = " + ".join(f"(substr(read_seq, {p + 1}, 1) = '{a}')::BIGINT" for p, (_, a) in sorted(SIGNATURE.snvs.items()))


@query(EDIT_SQL)
def edit_distance_outcome(spark, sf_dir):
    rows = reads(spark, sf_dir).withColumn("donor_id", F.lit("d1"))
    out = classify_edit.classify(rows, _signature(spark))
    counts = ["n_edits", "n_donor", "n_non_donor", "n_mmej", "n_nhej", "n_off_cut", "n_near_snv"]
    return out.select("seq_hash", "kind", "at", "n", "count", "outcome", *(whole(c).alias(c) for c in counts), F.round("donor_fraction", 6).alias("donor_fraction"))


@query(_table_sql(f"SELECT 's' || \"at\" % 4 AS sample_id, outcome, count FROM ({EDIT_SQL})"))
def edit_distance_table(spark, sf_dir):
    """The same as a sample table, weighted by reads."""
    rows = classify_edit.classify(reads(spark, sf_dir).withColumn("donor_id", F.lit("d1")), _signature(spark))
    return outcomes.weighted_table(rows.withColumn("sample_id", F.concat(F.lit("s"), F.col("at") % 4)))


@query(None)
def multi_donor_outcome(spark, sf_dir):
    second = align.donor_signature(REF, REF[20:55] + "CCC" + REF[58:100])
    signature = spark.createDataFrame(SIGNATURE.rows("d1") + second.rows("d2"), align.SIGNATURE_SCHEMA)
    donors = spark.createDataFrame([("d1", 0), ("d2", 1)], "donor_id string, ordinal int")
    out = classify_edit.classify_multi(reads(spark, sf_dir).withColumn("expected_donor", F.lit("d2")), signature, donors)
    return out.select("seq_hash", "best_donor_id", "outcome", F.round("score", 6).alias("score"), F.round("expected_score", 6).alias("expected_score"), "is_sample_swap", F.round("swap_confidence", 6).alias("swap_confidence"))


@query(None)
def signature_outcome(spark, sf_dir):
    pairs = lambda d: F.array(*(F.struct(F.lit(p).alias("pos"), F.lit(a).alias("alt")) for p, a in d)).cast("array<struct<pos:int,alt:string>>")
    rows = reads(spark, sf_dir).withColumn("is_mapped", F.lit(True)).withColumn("donor_seq", F.lit(DONOR)).withColumn("signature", pairs([(p, a) for p, (_, a) in SIGNATURE.snvs.items()])).withColumn("expected_insertions", F.array().cast("array<struct<pos:int,alt:string>>"))
    return classify_more.by_signature(rows).select("seq_hash", "kind", "outcome", F.round("confidence", 6).alias("confidence"), "mechanism", "is_large_deletion")


@query(f"""SELECT read_id, ordinal, l_suppkey, CASE WHEN deleted >= 6 THEN 'LARGE_DEL' WHEN is_mapped THEN CASE WHEN indel AND nm <= 3 THEN 'IMPERFECT' WHEN indel THEN 'NHEJ' WHEN nm = 0 THEN 'PERFECT' WHEN nm <= 3 THEN 'IMPERFECT' ELSE 'NHEJ' END
  ELSE CASE WHEN indel AND p <= 30 AND p + deleted >= 10 THEN 'NHEJ' WHEN nm <= 3 THEN 'WT' ELSE 'NHEJ' END END AS outcome FROM (SELECT *, l_quantity::BIGINT AS p, l_returnflag IN ('A', 'N') AS indel, CASE WHEN l_returnflag = 'N' THEN ordinal ELSE 0 END AS deleted FROM ({LINES}))""")
def multi_reference_outcome(spark, sf_dir):
    rows = lines(spark, sf_dir).select("read_id", "ordinal", "l_suppkey", F.col("is_mapped").alias("is_hdr"), "nm", "cigar", F.lit(0).alias("ref_start"), F.lit(20).alias("cut_site"))
    return classify_more.by_references(rows, 10, 3, 6).select("read_id", "ordinal", "l_suppkey", "outcome")


@query(_THREE)
def three_aligner_outcome(spark, sf_dir):
    rows = lines(spark, sf_dir).withColumn("ref_start", F.lit(0)).withColumn("cut_site", F.lit(20))
    return classify_more.by_three_aligners(rows, 12, 6, 5).select("read_id", "aligner", "penalty", "outcome")


@query(f"SELECT seq_hash, kind, CASE WHEN d = 0 THEN 'WT' WHEN d = {len(SIGNATURE.snvs)} THEN 'HDR_COMPLETE' ELSE 'HDR_PARTIAL' END AS outcome, d AS detected FROM (SELECT *, {_detected} AS d FROM ({READS}))")
def combination_outcome(spark, sf_dir):
    snvs = F.array(*(F.struct(F.lit(p).alias("pos"), F.lit(a).alias("alt")) for p, (_, a) in SIGNATURE.snvs.items()))
    rows = reads(spark, sf_dir).withColumn("snvs", snvs)
    return classify_more.by_combination(rows).select("seq_hash", "kind", "outcome", whole(F.size("detected")).alias("detected"))


@query(None)
def donor_capture(spark, sf_dir):
    rows = reads(spark, sf_dir).where("kind = 3").withColumn("donor_seq", F.lit("TTGATTACATT")).withColumn("insertions", F.array(F.struct(F.col("at").alias("position"), F.substring(F.lit("GATTACA"), F.lit(1), F.col("n")).alias("sequence"))))
    return classify_more.captured_insertion(rows, least=4).select("seq_hash", "is_donor_capture", "donor_capture_size", "donor_capture_distance", "junction_homology_left", "junction_homology_right", "mmej_class")
