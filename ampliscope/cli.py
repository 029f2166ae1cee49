"""Commands: python -m ampliscope.cli COMMAND --help."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ampliscope.operators import joins, kmers, outcomes, pool
from ampliscope.plans import amplicon
from ampliscope.sources import tables, text
from ampliscope.sources.config import Locus, locus_of_files


def _locus(spark: SparkSession, a: argparse.Namespace) -> Locus:
    return locus_of_files(spark, "locus", a.reference, a.hdr_template, a.guide, a.nuclease)


def run(spark: SparkSession, a: argparse.Namespace) -> None:
    tables.write_tsv(amplicon.run(spark, tables.sample_key(spark, a.sample_key), _locus(spark, a), a.min_global_count), a.output)


def multi_template(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = amplicon.read_samples(spark, tables.sample_key(spark, a.sample_key))
    tables.write_tsv(amplicon.run_templates(rows, _locus(spark, a)), a.output)


def info(spark: SparkSession, a: argparse.Namespace) -> None:
    locus = _locus(spark, a)
    print(f"guide at {locus.guide_start} ({locus.strand}), cut at {locus.cleavage}, k-mers of {locus.kmer_size}")
    for name, s in locus.signatures.items():
        print(f"{name}: {len(s.snvs)} SNVs, {len(s.insertions)} insertions, {len(s.deletions)} deletions, arms {locus.arms[name]}")


def aggregate(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = tables.tsv(spark, a.results)
    rates = [c for c in rows.columns if c.endswith(("_pct", "_rate"))]
    typed = rows.selectExpr(*(f"cast(`{c}` as double) as `{c}`" if c in rates or c == a.reads else f"`{c}`" for c in rows.columns))
    out = pool.pool(typed, a.sample, a.reads, [a.reads], rates, least=a.min_reads)
    tables.write_tsv(tables.formatted(out, {c: 4 for c, t in out.dtypes if t == "double"}), a.output)


def classify(spark: SparkSession, a: argparse.Namespace) -> None:
    """A Parquet or TSV table of labelled reads to the outcome table."""
    rows = spark.read.parquet(a.labels) if a.labels.endswith(".parquet") else tables.tsv(spark, a.labels)
    tables.write_tsv(outcomes.weighted_table(rows.selectExpr("sample_id", "outcome", "cast(count as long) as count")), a.output)


def extract_kmers(spark: SparkSession, a: argparse.Namespace) -> None:
    own = kmers.contaminant_only(text.sequence_or_file(spark, a.contaminant), text.sequence_or_file(spark, a.reference), a.k)
    spark.createDataFrame([(x,) for x in own], "value string").coalesce(1).write.mode("overwrite").text(a.output)


def generate_manifest(spark: SparkSession, a: argparse.Namespace) -> None:
    tables.write_tsv(joins.manifest(tables.tsv(spark, a.samples), tables.tsv(spark, a.plates), a.raw_dir, a.locus, a.replicate), a.output)


def generate_templates(spark: SparkSession, a: argparse.Namespace) -> None:
    arms = tables.tsv(spark, a.donors).select("left_homology_arm", "right_homology_arm").first()
    own = tables.barcodes(tables.tsv(spark, a.samples), a.column).collect()
    rows = [(r["id"], f"{arms[0]}{r['barcode']}{arms[1]}".upper()) for r in own]
    text.fasta_lines(spark.createDataFrame(rows, "name string, sequence string"), "name", "sequence").coalesce(1).write.mode("overwrite").text(a.output)


def init(_: SparkSession, a: argparse.Namespace) -> None:
    print(tables.sample_key_template(a.with_locus), end="")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ampliscope")
    sub = top.add_subparsers(required=True)

    def command(f, *options: tuple) -> None:
        p = sub.add_parser(f.__name__.replace("_", "-"), help=f.__doc__)
        p.set_defaults(run=f)
        for name, *default in options:
            kind = {} if not default else {"action": "store_true"} if default[0] is False else {"default": default[0], "type": type(default[0]) if default[0] is not None else str}
            p.add_argument(f"--{name}", required=not default, **kind)

    locus = [("reference",), ("hdr-template",), ("guide",), ("nuclease", "cas9")]
    command(run, ("sample-key",), *locus, ("min-global-count", 1), ("output",))
    command(multi_template, ("sample-key",), *locus, ("output",))
    command(info, *locus)
    command(classify, ("labels",), ("output",))
    command(aggregate, ("results",), ("sample", "bio_sample"), ("reads", "total_reads"), ("min-reads", 1000), ("output",))
    command(extract_kmers, ("contaminant",), ("reference",), ("k", 12), ("output",))
    command(generate_manifest, ("samples",), ("plates",), ("raw-dir",), ("locus", None), ("replicate", None), ("output",))
    command(generate_templates, ("samples",), ("donors",), ("column", "barcode"), ("output",))
    command(init, ("with-locus", False))
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    a.run(spark or SparkSession.builder.appName("ampliscope").getOrCreate(), a)


if __name__ == "__main__":
    main()
