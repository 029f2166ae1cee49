"""Collapse, labels and their way back to samples; dedup, ranking, clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from ampliscope.functions import cigar as C
from ampliscope.operators import classify_more, collapse, dedup, outcomes
from ampliscope.plans.base import DNA, EVENTS, LINES, dna, labelled, lines, query, table, whole

_K = {"wt": ["ACGT", "TTAA"], "hdr": ["GATC", "CCGG"], "contamination": ["TATATA"]}
_has = {k: " OR ".join(f"contains(dna, '{x}')" for x in v) for k, v in _K.items()}

_table = "SELECT sample_id, sum(count)::BIGINT AS total_reads, " + ", ".join(f"coalesce(sum(CASE WHEN outcome IN ({', '.join(repr(x) for x in v)}) THEN count ELSE 0 END), 0)::BIGINT AS \"{k}\"" for k, v in outcomes.TABLE_COUNTS.items()) + " FROM ({0}) GROUP BY sample_id"
_sums = ", ".join(" + ".join(f'"{x}"' for x in v) + f' AS "{k}"' for k, v in outcomes.TABLE_SUMS.items())
_pcts = ", ".join(f"CASE WHEN total_reads > 0 THEN ({' + '.join(f'"{x}"' for x in v)}) * 100.0::DOUBLE / total_reads ELSE 0.0 END AS \"{k}\"" for k, v in outcomes.TABLE_PERCENT.items())


def _table_sql(rows: str) -> str:
    return f"SELECT *, {_pcts} FROM (SELECT *, {_sums} FROM ({_table.format(rows)}))"


_LABELLED_DNA = f"""SELECT sample_id, dna, count(*)::BIGINT AS count, CASE WHEN ({_has["contamination"]}) AND NOT ({_has["hdr"]}) THEN 'CHIMERIC' WHEN ({_has["hdr"]}) AND NOT ({_has["wt"]}) THEN 'HDR_COMPLETE'
  WHEN ({_has["wt"]}) AND NOT ({_has["hdr"]}) THEN 'WT' WHEN ({_has["wt"]}) AND ({_has["hdr"]}) THEN 'AMBIGUOUS' ELSE 'UNKNOWN' END AS outcome FROM ({DNA}) GROUP BY sample_id, dna"""


@query(_table_sql(_LABELLED_DNA))
def classify_join_back(spark, sf_dir):
    """The flagship: collapse, label each distinct sequence once, join back weighted, pivot per sample."""
    mapped = collapse.collapse(dna(spark, sf_dir), ["sample_id", "dna"])

    def expensive(distinct):
        flags = classify_more.kmer_flags(distinct, "dna", _K)
        label = classify_more.kmer_label(F.col("has_wt"), F.col("has_hdr"), F.col("has_contamination"))
        names = F.when(label == "CONTAMINATION", "CHIMERIC").when(label == "HDR", "HDR_COMPLETE").otherwise(label)
        return flags.select("dna", names.alias("outcome"))

    return outcomes.weighted_table(collapse.once_each(mapped, ["dna"], expensive))


@query("SELECT event_type, CASE WHEN count(DISTINCT CASE WHEN user_id % 5 != 0 THEN user_id END) > 0 THEN count(DISTINCT CASE WHEN user_id % 5 != 0 THEN user_id END) ELSE count(*) END AS count, count(*) AS total_reads, count(DISTINCT CASE WHEN user_id % 5 != 0 THEN user_id END) > 0 AS has_umi FROM events GROUP BY event_type")
def collapse_umi(spark, sf_dir):
    reads = table(spark, sf_dir, "events").withColumn("umi", F.when(F.col("user_id") % 5 != 0, F.col("user_id").cast("string")).otherwise(""))
    return collapse.collapse_umi(reads, ["event_type"])


@query(f"SELECT sample_id, count(*) AS count, max(length(dna))::BIGINT AS best_score, arg_min(dna, (-length(dna), dna)) AS dna FROM ({DNA}) GROUP BY sample_id")
def collapse_keep_best(spark, sf_dir):
    return collapse.collapse_keep_best(dna(spark, sf_dir), ["sample_id"], "dna", whole(F.length("dna")))


_COLLAPSED = f"SELECT sample_id, dna AS r1, lang AS r2, lang AS guide, 'd' || lang AS donor, count(*) AS count FROM ({DNA}) GROUP BY ALL"
_KEYED = f"SELECT *, md5(r1 || '|' || r2) AS seq_hash FROM ({_COLLAPSED})"


def _collapsed(spark, sf_dir):
    rows = dna(spark, sf_dir).select("sample_id", F.col("dna").alias("r1"), F.col("lang").alias("r2"), F.col("lang").alias("guide"), F.concat(F.lit("d"), "lang").alias("donor"))
    return collapse.collapse(rows, rows.columns)


@query(f"SELECT seq_hash, min(r1) AS r1_sequence, min(r2) AS r2_sequence, sum(count)::BIGINT AS total_count FROM ({_KEYED}) GROUP BY seq_hash")
def global_unique(spark, sf_dir):
    return collapse.global_unique(_collapsed(spark, sf_dir))[0]


@query(f"SELECT seq_hash, min(r1) AS r1_sequence, min(r2) AS r2_sequence, 2 * sum(count)::BIGINT AS total_count FROM ({_KEYED}) GROUP BY seq_hash")
def global_unique_upsert(spark, sf_dir):
    unique = collapse.global_unique(_collapsed(spark, sf_dir))[0]
    return collapse.upsert_unique(unique, unique)


@query(f"""SELECT * FROM (SELECT count(*) AS unique_pairs, sum(CASE WHEN r2_sequence != '' THEN total_count ELSE 0 END)::BIGINT AS paired_reads, sum(CASE WHEN r2_sequence != '' THEN 0 ELSE total_count END)::BIGINT AS single_reads, sum(total_count)::BIGINT AS total_reads
  FROM (SELECT seq_hash, min(r2) AS r2_sequence, sum(count) AS total_count FROM ({_KEYED}) GROUP BY seq_hash)), (SELECT count(*) AS mappings, count(DISTINCT sample_id) AS samples, count(DISTINCT (seq_hash, guide, donor)) AS combinations FROM ({_KEYED}))""")
def store_statistics(spark, sf_dir):
    unique, mappings = collapse.global_unique(_collapsed(spark, sf_dir))
    return collapse.store_statistics(mappings, unique)


@query(f"SELECT sample_id, dna, count FROM (SELECT sample_id, dna, count(*) AS count, sum(count(*)) OVER (PARTITION BY dna) AS t FROM ({DNA}) GROUP BY sample_id, dna) WHERE t >= 2")
def min_global_count(spark, sf_dir):
    return collapse.min_global_count(collapse.collapse(dna(spark, sf_dir), ["sample_id", "dna"]), "dna", 2)


@query(f"SELECT sample_id, dna, count, rank FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY count DESC, dna)::INT AS rank FROM (SELECT sample_id, dna, count(*) AS count FROM ({DNA}) GROUP BY sample_id, dna)) WHERE rank <= 3")
def top_sequences(spark, sf_dir):
    return collapse.top_sequences(collapse.collapse(dna(spark, sf_dir), ["sample_id", "dna"]), "sample_id", "dna", 3)


@query(f"SELECT DISTINCT guide, donor, substr(md5(guide || '|' || donor), 1, 12) AS combo_id FROM ({_COLLAPSED})")
def combinations(spark, sf_dir):
    return collapse.combinations(_collapsed(spark, sf_dir))


@query(f"""SELECT doc_id, upper(substr(dna, 9)) AS r1, upper(substr(lang, 2)) AS r2, upper(CASE WHEN length(substr(dna, 1, 6)) > 0 AND length(substr(lang, 1, 1)) > 0 THEN substr(dna, 1, 6) || '_' || substr(lang, 1, 1) WHEN length(substr(dna, 1, 6)) > 0 THEN substr(dna, 1, 6) ELSE substr(lang, 1, 1) END) AS umi
  FROM ({DNA}) WHERE length(dna) > 8 AND coalesce(length(lang), 2) > 1""")
def trim_umi(spark, sf_dir):
    return collapse.trim_umi(dna(spark, sf_dir).select("doc_id", F.col("dna").alias("r1"), F.col("lang").alias("r2")), 6, 8, 1, 1)


@query(_table_sql(EVENTS))
def outcome_table(spark, sf_dir):
    return outcomes.weighted_table(labelled(spark, sf_dir))


_SIG = {"click": "hdr_complete", "view": "wt", "purchase": "nhej_indel", "signup": "donor_capture", "error": "unmapped"}
_sig_counts = ", ".join(f"count(*) FILTER (outcome = '{x}') AS {x}" for x in outcomes.SIG_LABELS)
_sig_rates = ", ".join(f"CASE WHEN classifiable > 0 THEN {n} / classifiable ELSE 0.0 END AS {n}_rate" for n in [*outcomes.SIG_LABELS[:-1], "hdr_total", "nhej_mmej_total", "edited_total"])


@query(f"""SELECT *, {_sig_rates} FROM (SELECT *, hdr_total + nhej_mmej_total + donor_capture AS edited_total FROM (SELECT *, total - unmapped AS classifiable, {" + ".join(outcomes.HDR_5)} AS hdr_total, nhej_indel + mmej_indel AS nhej_mmej_total
  FROM (SELECT user_id, count(*) AS total, {_sig_counts} FROM (SELECT user_id, CASE event_type {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _SIG.items())} END AS outcome FROM events) GROUP BY user_id)))""")
def outcome_summary(spark, sf_dir):
    names = F.create_map(*(F.lit(x) for kv in _SIG.items() for x in kv))
    return outcomes.summarize(table(spark, sf_dir, "events").select("user_id", F.element_at(names, F.col("event_type")).alias("outcome")), ["user_id"])


@query(f"SELECT sample_id, outcome, sum(count)::BIGINT AS reads FROM ({EVENTS}) GROUP BY ALL")
def outcome_histogram(spark, sf_dir):
    return outcomes.histogram(labelled(spark, sf_dir), ["sample_id"], "outcome", "count")


@query("""UNPIVOT (SELECT user_id, count(*) FILTER (event_type = 'click') AS hdr, count(*) FILTER (event_type = 'view') AS wt, count(*) FILTER (event_type = 'error') AS nhej FROM events GROUP BY user_id HAVING true) ON hdr, wt, nhej INTO NAME category VALUE count""".replace("UNPIVOT (", "SELECT * FROM (UNPIVOT (") + ") WHERE count > 0")
def granular_unpivot(spark, sf_dir):
    t = table(spark, sf_dir, "events")
    of = lambda e, n: F.sum((F.col("event_type") == e).cast("long")).alias(n)
    return outcomes.granular(t.groupBy("user_id").agg(of("click", "hdr"), of("view", "wt"), of("error", "nhej")), "user_id", ["hdr", "wt", "nhej"])


@query("SELECT l_suppkey, (l_linenumber)::INT AS pos, count, hdr_reads, coalesce(count / hdr_reads, 0.0) AS frequency, (l_linenumber - 4)::INT AS distance FROM (SELECT s.l_suppkey, p.l_linenumber, coalesce(c.count, 0) AS count, s.hdr_reads FROM (SELECT l_suppkey, count(*) AS hdr_reads FROM (SELECT l_suppkey, l_orderkey FROM lineitem GROUP BY ALL) GROUP BY l_suppkey) s CROSS JOIN (SELECT DISTINCT l_linenumber FROM lineitem) p LEFT JOIN (SELECT l_suppkey, l_linenumber, count(DISTINCT l_orderkey) AS count FROM lineitem GROUP BY ALL) c ON c.l_suppkey = s.l_suppkey AND c.l_linenumber = p.l_linenumber)")
def snv_integration(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem")
    reads = t.groupBy("l_suppkey", "l_orderkey").agg(F.collect_set("l_linenumber").alias("donor_snvs_detected")).withColumn("outcome", F.lit("HDR_PARTIAL"))
    return outcomes.snv_integration(reads, ["l_suppkey"], t.select(F.col("l_linenumber").alias("pos")), 4)


@query("""WITH r AS (SELECT l_orderkey, l_linenumber AS p, l_returnflag FROM lineitem GROUP BY ALL), n AS (SELECT l_returnflag, p, count(DISTINCT l_orderkey) AS n FROM r GROUP BY ALL),
b AS (SELECT x.l_returnflag, x.p AS a, y.p AS b, count(DISTINCT x.l_orderkey) AS both FROM r x JOIN r y ON x.l_orderkey = y.l_orderkey AND x.l_returnflag = y.l_returnflag AND x.p < y.p GROUP BY ALL)
SELECT b.l_returnflag, b.a, b.b, b.both, n1.n + n2.n - b.both AS either, b.both / (n1.n + n2.n - b.both) AS jaccard FROM b JOIN n n1 ON n1.p = b.a AND n1.l_returnflag = b.l_returnflag JOIN n n2 ON n2.p = b.b AND n2.l_returnflag = b.l_returnflag""")
def cooccurrence_jaccard(spark, sf_dir):
    reads = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.collect_set("l_linenumber").alias("donor_snvs_detected"))
    return outcomes.cooccurrence(reads, ["l_returnflag"])


_SWAP = "SELECT user_id AS sample_id, 'click' AS expected_donor, event_type AS best_donor_id, (floor(abs(value)) + 1)::BIGINT AS count FROM events"


@query(f"""WITH p AS (SELECT sample_id, expected_donor, best_donor_id, sum(count)::BIGINT AS n FROM ({_SWAP}) GROUP BY ALL),
t AS (SELECT sample_id, expected_donor, sum(n)::BIGINT AS total_hdr_reads, arg_max(best_donor_id, (n, best_donor_id)) AS detected_donor, max(n) AS swap_reads, coalesce(sum(CASE WHEN best_donor_id = expected_donor THEN n END), 0)::BIGINT AS expected_reads FROM p GROUP BY ALL)
SELECT *, swap_reads / total_hdr_reads AS swap_fraction, detected_donor != expected_donor AND swap_reads > expected_reads AND swap_reads / total_hdr_reads > 0.5 AS is_swap, swap_reads / total_hdr_reads AS confidence FROM t""")
def swap_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("sample_id"), F.lit("click").alias("expected_donor"), F.col("event_type").alias("best_donor_id"), (F.floor(F.abs("value")) + 1).cast("long").alias("count"))
    return outcomes.swap_summary(rows)


_PRIORITY = "CASE aligner WHEN 'bwa' THEN 0 WHEN 'bbmap' THEN 1 WHEN 'minimap2' THEN 2 ELSE 99 END"


@query(f"SELECT read_id, aligner, penalty FROM (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY penalty, {_PRIORITY}, aligner, l_partkey, ordinal) AS n FROM ({LINES})) WHERE n = 1")
def best_alignment(spark, sf_dir):
    return dedup.best_by_penalty(lines(spark, sf_dir)).select("read_id", "aligner", "penalty")


@query(f"SELECT read_id, score, nm, is_mapped FROM (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY is_mapped DESC, score DESC, nm, ordinal) AS n FROM ({LINES})) WHERE n = 1")
def best_alignment_by_score(spark, sf_dir):
    return dedup.best_by_score(lines(spark, sf_dir)).select("read_id", "score", "nm", "is_mapped")


@query(f"SELECT read_id, aligner, penalty FROM (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY penalty, {_PRIORITY}) AS n FROM (SELECT a.read_id, a.aligner, a.p + b.p AS penalty FROM (SELECT read_id, aligner, min(penalty) AS p FROM ({LINES}) WHERE l_returnflag != 'R' GROUP BY ALL) a JOIN (SELECT read_id, aligner, max(penalty) AS p FROM ({LINES}) WHERE l_returnflag = 'R' GROUP BY ALL) b USING (read_id, aligner))) WHERE n = 1")
def best_pair(spark, sf_dir):
    t = lines(spark, sf_dir)
    r1 = t.where("l_returnflag != 'R'").groupBy("read_id", "aligner").agg(F.min("penalty").alias("penalty"))
    r2 = t.where("l_returnflag = 'R'").groupBy("read_id", "aligner").agg(F.max("penalty").alias("penalty"))
    return dedup.best_pair(r1, r2).select("read_id", "aligner", "penalty")


@query(f"SELECT l_suppkey, start, \"end\", cigar, read_idx FROM (SELECT l_suppkey, start, start + l_quantity::BIGINT AS \"end\", cigar, read_id * 10 + ordinal AS read_idx, row_number() OVER (PARTITION BY l_suppkey, start, l_quantity::BIGINT, cigar ORDER BY read_id * 10 + ordinal) AS n FROM ({LINES})) WHERE n = 1")
def position_dedup(spark, sf_dir):
    t = lines(spark, sf_dir).select("l_suppkey", "start", (F.col("start") + whole("l_quantity")).alias("end"), "cigar", (F.col("read_id") * 10 + F.col("ordinal")).alias("read_idx"))
    return dedup.position_dedup(t, sample=["l_suppkey"])


@query("SELECT umi, read_idx, mean_quality FROM (SELECT user_id AS umi, event_id AS read_idx, round(value, 3) AS mean_quality, row_number() OVER (PARTITION BY user_id ORDER BY round(value, 3) DESC, event_id) AS n FROM events) WHERE n = 1")
def umi_dedup(spark, sf_dir):
    t = table(spark, sf_dir, "events").select(F.col("user_id").alias("umi"), F.col("event_id").alias("read_idx"), F.round("value", 3).alias("mean_quality"))
    return dedup.umi_dedup(t)


@query("""SELECT user_id, cluster, count(*) AS n, min(event_id) AS first FROM (SELECT *, sum(CASE WHEN epoch_us(ts) - lag_us > 3600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id RANGE UNBOUNDED PRECEDING)::BIGINT AS cluster
  FROM (SELECT *, lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS lag_us FROM events)) GROUP BY ALL""")
def gap_cluster(spark, sf_dir):
    rows = dedup.cluster_by_gap(table(spark, sf_dir, "events"), ["user_id"], F.unix_micros(F.col("ts").cast("timestamp")), 3_600_000_000)
    return rows.groupBy("user_id", whole("cluster").alias("cluster")).agg(F.count("*").alias("n"), F.min("event_id").alias("first"))


@query(f"""SELECT read_id, ordinal, cigar, CASE l_returnflag WHEN 'R' THEN 0 ELSE 0 END + l_quantity::BIGINT + l_partkey % 30 + 1 + CASE l_returnflag WHEN 'N' THEN ordinal ELSE 0 END AS reference_length, l_quantity::BIGINT + l_partkey % 30 + 1 + CASE l_returnflag WHEN 'N' THEN 0 ELSE ordinal END AS query_length,
  CASE WHEN l_returnflag NOT IN ('A', 'N') THEN ordinal ELSE 0 END::BIGINT AS soft_clips, CASE l_returnflag WHEN 'A' THEN ordinal ELSE 0 END::BIGINT AS inserted, CASE l_returnflag WHEN 'N' THEN ordinal ELSE 0 END::BIGINT AS deleted FROM ({LINES})""")
def cigar_lengths(spark, sf_dir):
    c = F.col("cigar")
    return lines(spark, sf_dir).select("read_id", "ordinal", "cigar", whole(C.reference_length(c)).alias("reference_length"), whole(C.query_length(c)).alias("query_length"), whole(C.soft_clips(c)).alias("soft_clips"), whole(C.inserted(c)).alias("inserted"), whole(C.deleted(c)).alias("deleted"))


@query(f"""SELECT read_id, ordinal, o.i::BIGINT AS i, substr(o.p, -1) AS op, o.n AS n, start + coalesce(sum(CASE WHEN substr(o.p, -1) IN ('M', 'D') THEN o.n END) OVER w, 0)::BIGINT AS ref, coalesce(sum(CASE WHEN substr(o.p, -1) IN ('M', 'I', 'S') THEN o.n END) OVER w, 0)::BIGINT AS query
  FROM (SELECT *, unnest(list_transform(regexp_extract_all(cigar, '\\d+[MIDNSHP=X]'), lambda x, i: {{'p': x, 'i': i - 1, 'n': regexp_extract(x, '\\d+')::BIGINT}})) AS o FROM ({LINES})) WINDOW w AS (PARTITION BY read_id, ordinal, cigar, start, l_suppkey, l_extendedprice ORDER BY o.i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def cigar_operations(spark, sf_dir):
    ops = C.operations(F.col("cigar"), F.col("start"))
    return lines(spark, sf_dir).select("read_id", "ordinal", F.posexplode(ops).alias("i", "o")).select("read_id", "ordinal", whole("i").alias("i"), "o.op", whole("o.n").alias("n"), whole("o.ref").alias("ref"), whole("o.query").alias("query"))


_MD = "l_partkey % 50 || 'A' || l_linenumber || '^' || CASE l_returnflag WHEN 'A' THEN 'ACG' WHEN 'N' THEN 'T' ELSE 'GG' END || l_suppkey % 9 || CASE WHEN l_linenumber > 3 THEN 'TC' ELSE '' END"


@query(f"SELECT l_orderkey, l_linenumber, {_MD} AS md, length(regexp_replace(regexp_replace({_MD}, '\\^[A-Z]+', '', 'g'), '[^A-Za-z]', '', 'g'))::BIGINT AS mismatches FROM lineitem")
def md_mismatches(spark, sf_dir):
    flag = F.when(F.col("l_returnflag") == "A", "ACG").when(F.col("l_returnflag") == "N", "T").otherwise("GG")
    md = F.concat(F.col("l_partkey") % 50, F.lit("A"), "l_linenumber", F.lit("^"), flag, F.col("l_suppkey") % 9, F.when(F.col("l_linenumber") > 3, "TC").otherwise(""))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", md.alias("md"), whole(C.md_mismatches(md)).alias("mismatches"))
