"""Sequence expressions over the documents' DNA."""

from __future__ import annotations

from pyspark.sql import functions as F

from ampliscope.functions import dna as D
from ampliscope.functions import homology as H
from ampliscope.operators import joins
from ampliscope.plans.base import DNA, dna, query, table, whole

_RC = "reverse(translate({0}, 'ACGTacgt', 'TGCAtgca'))"
_TEXT = "coalesce(text, '')"
_MASKED = f"regexp_replace({_RC.format(_TEXT)}, '[^ACGTNacgtn]', 'N', 'g')"


@query(f"SELECT doc_id, {_MASKED} AS mask, upper({_MASKED}) AS mask_upper, reverse(translate({_TEXT}, 'ACGTacgt', 'TGCAtgca')) AS keep, reverse(translate({_TEXT}, 'ACGTRYSWKMBDHVNacgtryswkmbdhvn', 'TGCAYRSWMKVHDBNtgcayrswmkvhdbn')) AS iupac FROM documents")
def reverse_complement(spark, sf_dir):
    t = F.coalesce("text", F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", *(D.reverse_complement(t, m).alias(m) for m in ("mask", "mask_upper", "keep", "iupac")))


@query(f"SELECT doc_id, CASE WHEN length(dna) > 0 THEN length(regexp_replace(dna, '[^GC]', '', 'g')) / length(dna) ELSE 0.0 END AS gc FROM ({DNA})")
def gc_content(spark, sf_dir):
    return dna(spark, sf_dir).select("doc_id", D.gc_content(F.col("dna")).alias("gc"))


@query(f"SELECT doc_id, (SELECT count(*) FROM range(1, length(dna) + 1) t(i) WHERE substr(dna, i, 1) != substr(reverse(dna), i, 1)) AS distance FROM ({DNA})")
def hamming(spark, sf_dir):
    return dna(spark, sf_dir).select("doc_id", whole(D.hamming(F.lower("dna"), F.reverse("dna"))).alias("distance"))


@query("SELECT a.p_partkey, b.p_partkey AS other, levenshtein(a.p_name, b.p_name)::BIGINT AS distance FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1")
def levenshtein(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    q = p.select(F.col("p_partkey").alias("other"), F.col("p_name").alias("b"))
    return p.join(q, q.other == p.p_partkey + 1).select("p_partkey", "other", whole(F.levenshtein("p_name", "b")).alias("distance"))


_codons = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sorted(D.CODONS.items()))


@query(f"SELECT doc_id, coalesce(string_agg(CASE substr(dna, i::BIGINT, 3) {_codons} ELSE 'X' END, '' ORDER BY i) FILTER (i IS NOT NULL), '') AS protein FROM (SELECT doc_id, dna, unnest(CASE WHEN length(dna) >= 1 THEN range(1, length(dna) + 1, 3) ELSE [NULL] END) AS i FROM ({DNA})) GROUP BY doc_id")
def translate_codons(spark, sf_dir):
    n = F.length("dna")
    starts = F.when(n >= 1, F.sequence(F.lit(1), n, F.lit(3))).otherwise(F.array().cast("array<int>"))
    protein = F.array_join(F.transform(starts, lambda i: D.translate_codon(F.substring("dna", i, F.lit(3)))), "")
    return dna(spark, sf_dir).select("doc_id", protein.alias("protein"))


@query(f"SELECT doc_id, unnest(list_filter(range(0, length(dna) - 2), lambda i: substr(dna, i + 1, 3) = 'ACA'))::BIGINT AS position FROM ({DNA})")
def kmer_positions(spark, sf_dir):
    return dna(spark, sf_dir).select("doc_id", F.explode(D.kmer_positions(F.col("dna"), F.lit("ACA"))).alias("position")).withColumn("position", whole("position"))


@query(f"SELECT doc_id, i + 1 - 1 AS start, substr(dna, i + 1, 6) AS kmer FROM (SELECT doc_id, dna, unnest(range(greatest(0, 20 - 5), least(20, length(dna) - 6) + 1)) AS i FROM ({DNA}))")
def kmers_spanning(spark, sf_dir):
    return dna(spark, sf_dir).select("doc_id", F.explode(D.kmers_spanning(F.col("dna"), F.lit(20), 6)).alias("k")).select("doc_id", whole("k.start").alias("start"), "k.kmer")


_BENCH = "SELECT regexp_replace(upper(text), '[^ACGT]', '', 'g') AS s FROM benchmark"


def _own(rows: str, column: str, k: int) -> str:
    return f"SELECT unnest(list_transform(range(1, length({column}) - {k} + 2), lambda i: substr({column}, i, {k}))) AS kmer FROM ({rows})"


@query(f"SELECT DISTINCT kmer FROM ({_own(DNA, 'dna', 8)}) EXCEPT (SELECT kmer FROM ({_own(_BENCH, 's', 8)}) UNION SELECT {_RC.format('kmer')} FROM ({_own(_BENCH, 's', 8)}))")
def kmer_unique_minus(spark, sf_dir):
    other = table(spark, sf_dir, "benchmark").select(F.regexp_replace(F.upper("text"), "[^ACGT]", "").alias("sequence"))
    return joins.unique_kmers(dna(spark, sf_dir).select(F.col("dna").alias("sequence")), other, 8)


@query(f"SELECT doc_id, dna FROM ({DNA}) WHERE doc_id NOT IN (SELECT doc_id FROM (SELECT doc_id, unnest(list_transform(range(1, length(dna) - 10), lambda i: substr(dna, i, 12))) AS kmer FROM ({DNA})) WHERE kmer IN (SELECT kmer FROM ({_own(_BENCH, 's', 12)})))")
def contamination_anti(spark, sf_dir):
    bad = table(spark, sf_dir, "benchmark").select(F.explode(D.kmers(F.regexp_replace(F.upper("text"), "[^ACGT]", ""), 12)).alias("kmer"))
    rows = dna(spark, sf_dir).select("doc_id", "dna", F.lit(None).cast("string").alias("r2"))
    return joins.without_kmers(rows, "doc_id", "dna", "r2", bad, 12).drop("r2")


@query(f"SELECT doc_id, name, count(*) AS hits FROM (SELECT doc_id, unnest(list_transform(range(1, length(dna) - 2), lambda i: substr(dna, i, 4))) AS kmer FROM ({DNA})) JOIN (VALUES ('t1', 'ACGT'), ('t1', 'GATC'), ('t2', 'TTAA'), ('t2', 'CCGG')) w(name, kmer) USING (kmer) GROUP BY ALL")
def kmer_hits(spark, sf_dir):
    wanted = spark.createDataFrame([("t1", "ACGT"), ("t1", "GATC"), ("t2", "TTAA"), ("t2", "CCGG")], "name string, kmer string")
    return joins.kmer_hits(dna(spark, sf_dir), "doc_id", "dna", wanted, 4)


@query(f"SELECT doc_id, CASE WHEN contains(dna, 'ACATT') THEN strpos(dna, 'ACATT') - 1 WHEN contains(dna, 'AATGT') THEN strpos(dna, 'AATGT') - 1 END AS position, CASE WHEN contains(dna, 'ACATT') THEN '+' WHEN contains(dna, 'AATGT') THEN '-' END AS strand, CASE WHEN contains(dna, 'ACATT') THEN strpos(dna, 'ACATT') + 1 WHEN contains(dna, 'AATGT') THEN strpos(dna, 'AATGT') + 2 ELSE length(dna) // 2 END AS cut FROM ({DNA})")
def guide_and_cut(spark, sf_dir):
    g = F.lit("ACATT")
    at = D.find_guide(F.col("dna"), g)
    return dna(spark, sf_dir).select("doc_id", whole(at["position"]).alias("position"), at["strand"].alias("strand"), whole(D.cut_site(F.col("dna"), g)).alias("cut"))


@query(f"SELECT doc_id, i::BIGINT AS position, substr(dna, i + 1, 1) AS wt, substr(reverse(dna), i + 1, 1) AS hdr FROM (SELECT doc_id, dna, unnest(range(0, length(dna))) AS i FROM ({DNA})) WHERE substr(dna, i + 1, 1) != substr(reverse(dna), i + 1, 1)")
def hdr_signature(spark, sf_dir):
    s = D.signature(F.col("dna"), F.reverse("dna"))
    return dna(spark, sf_dir).select("doc_id", F.explode(s).alias("s")).select("doc_id", whole("s.position").alias("position"), "s.wt", "s.hdr")


@query(f"SELECT doc_id, length(regexp_extract(substr(dna, 11, 15), '^(A+|C+|G+|T+)')) + length(regexp_extract(reverse(substr(dna, 1, 11)), '^(A+|C+|G+|T+)')) - 1 AS run FROM ({DNA}) WHERE length(dna) > 10")
def homopolymer_run(spark, sf_dir):
    return dna(spark, sf_dir).where(F.length("dna") > 10).select("doc_id", whole(D.homopolymer(F.col("dna"), F.lit(10))).alias("run"))


@query(f"SELECT doc_id, CASE WHEN length(dna) > 12 THEN substr(dna, 1, 5) || 'TTT' || substr(dna, 8) ELSE dna END AS edited, md5(dna || '|' || lang) AS pair_key, 'donor_' || substr(md5(dna), 1, 8) AS donor_id FROM ({DNA})")
def variants_and_keys(spark, sf_dir):
    s = F.col("dna")
    edited = F.when(F.length(s) > 12, D.apply_variant(s, F.lit(5), F.lit("NN"), F.lit("TTT"))).otherwise(s)
    return dna(spark, sf_dir).select("doc_id", edited.alias("edited"), D.pair_key(s, F.col("lang")).alias("pair_key"), D.donor_id(s).alias("donor_id"))


_D0, _DN = 40, 6


@query(f"""SELECT doc_id, coalesce(list_max(list_filter(range(1, least({_DN}, {_D0}) + 1), lambda i: substr(dna, {_D0 + 1}, i) = substr(dna, {_D0} - i + 1, i))), 0)::BIGINT AS "left",
  coalesce(list_max(list_filter(range(1, least({_DN}, length(dna) - {_D0 + _DN}) + 1), lambda i: substr(dna, {_D0 + _DN} - i + 1, i) = substr(dna, {_D0 + _DN + 1}, i))), 0)::BIGINT AS "right" FROM ({DNA}) WHERE length(dna) >= {_D0 + _DN}""")
def microhomology(spark, sf_dir):
    s = F.col("dna")
    h = H.indel_homology(F.lit("deletion"), F.lit(_D0), F.substring(s, _D0 + 1, _DN), s)
    return dna(spark, sf_dir).where(F.length(s) >= _D0 + _DN).select("doc_id", whole(h["left"]).alias("left"), whole(h["right"]).alias("right"))


@query(f"""SELECT doc_id, coalesce(list_max(list_filter(range(1, least(4, 30) + 1), lambda i: right(ins, i) = substr(dna, 30 - i + 1, i))), 0)::BIGINT AS "left", coalesce(list_max(list_filter(range(1, least(4, length(dna) - 30) + 1), lambda i: left(ins, i) = substr(dna, 31, i))), 0)::BIGINT AS "right" FROM (SELECT doc_id, dna, 'ACAT' AS ins FROM ({DNA})) WHERE length(dna) >= 30""")
def insertion_homology(spark, sf_dir):
    s = F.col("dna")
    h = H.indel_homology(F.lit("insertion"), F.lit(30), F.lit("ACAT"), s)
    return dna(spark, sf_dir).where(F.length(s) >= 30).select("doc_id", whole(h["left"]).alias("left"), whole(h["right"]).alias("right"))


@query(f"SELECT doc_id, coalesce(list_max(list_filter(range(2, least(10, length(dna)) + 1), lambda i: right(dna, i) = left(dna, i))), 0)::BIGINT AS shared FROM ({DNA})")
def shared_end(spark, sf_dir):
    return dna(spark, sf_dir).select("doc_id", whole(F.length(H.shared_end(F.col("dna"), F.col("dna")))).alias("shared"))


@query("SELECT c_custkey, upper(trim(c_mktsegment)) NOT IN ('NA', 'EMPTY', 'NONE', 'NULL', 'CONTROL', 'N/A', '') AND regexp_full_match(upper(trim(c_mktsegment)), '[ACGT]+') AS valid, CASE WHEN upper(trim(c_mktsegment)) NOT IN ('NA', 'NAN', '') THEN c_mktsegment END AS kept FROM customer")
def barcode_predicates(spark, sf_dir):
    c = F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select("c_custkey", D.valid_barcode(c).alias("valid"), D.null_if_missing(c).alias("kept"))


@query("SELECT p_partkey, CASE WHEN length(p_name) > 0 THEN list_sum(list_transform(range(1, length(p_name) + 1), lambda i: ascii(substr(p_name, i, 1)) - 33)) / length(p_name) ELSE 0.0 END AS quality, CASE WHEN p_partkey % 2 = 0 THEN p_partkey % 90 ELSE 1 END::BIGINT AS count, regexp_extract('s' || p_partkey || '_A_7', '(s\\d+)_(\\w)_', 1) || '_' || regexp_extract('s' || p_partkey || '_A_7', '(s\\d+)_(\\w)_', 2) AS bio FROM part")
def names_and_quality(spark, sf_dir):
    k = F.col("p_partkey")
    name = F.when(k % 2 == 0, F.concat(F.lit("r_count="), k % 90)).otherwise("r")
    bio = D.bio_sample(F.concat(F.lit("s"), k, F.lit("_A_7")), r"(s\d+)_(\w)_", 2)
    return table(spark, sf_dir, "part").select("p_partkey", D.mean_quality(F.col("p_name")).alias("quality"), whole(D.count_in_name(name)).alias("count"), bio.alias("bio"))
