"""Configuration: loci, tracks, pipelines, batch settings. Read on the driver; a few values each."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampliscope.operators import align
from ampliscope.sources import tables, text


def yaml(source: str) -> dict:
    """The part of YAML that configurations use: nested maps by indentation, scalars, lists of scalars."""
    root: dict = {}
    stack: list[tuple[int, dict | list]] = [(-1, root)]
    last: tuple[dict, str] | None = None
    for line in source.splitlines():
        bare = re.sub(r"\s+#.*$|^#.*$", "", line).rstrip()
        if not bare.strip():
            continue
        indent, item = len(bare) - len(bare.lstrip()), bare.strip()
        if item.startswith("- "):
            if last and last[0][last[1]] is None:
                last[0][last[1]] = []
            if last and isinstance(last[0][last[1]], list):
                last[0][last[1]].append(_scalar(item[2:]))
            continue
        while stack[-1][0] >= indent:
            stack.pop()
        if last and last[0][last[1]] is None and indent > stack[-1][0] and last[0] is stack[-1][1] and indent > last_indent:
            last[0][last[1]] = {}
            stack.append((last_indent, last[0][last[1]]))
        key, _, value = item.partition(":")
        now = stack[-1][1]
        now[key.strip()] = _scalar(value.strip()) if value.strip() else None
        last, last_indent = (now, key.strip()), indent
    return root


def _scalar(value: str):
    quoted = re.fullmatch(r"'(.*)'|\"(.*)\"", value)
    if quoted:
        return quoted[1] if quoted[1] is not None else quoted[2]
    known = {"true": True, "yes": True, "false": False, "no": False, "null": None, "~": None}
    if value.lower() in known:
        return known[value.lower()]
    return int(value) if re.fullmatch(r"-?\d+", value) else float(value) if re.fullmatch(r"-?\d+\.\d*", value) else value


@dataclass
class Locus:
    """A reference, its HDR templates and guide, with what follows from them."""

    name: str
    reference: str
    templates: dict[str, str]
    guide: str
    nuclease: str = "cas9"
    strand: str = field(init=False)
    guide_start: int = field(init=False)
    cleavage: int = field(init=False)
    signatures: dict[str, align.Signature] = field(init=False)

    def __post_init__(self):
        self.reference, self.guide = self.reference.upper(), self.guide.upper()
        at, turned = self.reference.find(self.guide), self.reference.find(align.reverse_complement(self.guide))
        if not self.guide or max(at, turned) < 0:
            raise ValueError(f"{self.name}: the guide isn't in the reference")
        self.strand, self.guide_start = ("+", at) if at >= 0 else ("-", turned)
        n, plus = len(self.guide), at >= 0
        if self.nuclease == "cas9":
            self.cleavage = at + n - 3 if plus else turned + 3
        else:
            self.cleavage = at - 4 + 18 if plus else turned + n + 4 - 18
        self.signatures = {k: align.donor_signature(self.reference, t) for k, t in self.templates.items()}

    @property
    def arms(self) -> dict[str, tuple[tuple[int, int], tuple[int, int]]]:
        return {k: align.homology_arms(s, len(self.reference)) for k, s in self.signatures.items()}

    @property
    def kmer_size(self) -> int:
        return max((align.recommended_k(s) for s in self.signatures.values()), default=12)

    def positions(self) -> dict[str, list[int]]:
        return {k: sorted({*s.snvs, *s.insertions, *s.deletions}) for k, s in self.signatures.items()}

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [r for k, s in self.signatures.items() for r in s.rows(k)]
        return spark.createDataFrame(rows, align.SIGNATURE_SCHEMA)


def locus_of_files(spark: SparkSession, name: str, reference: str, templates: str, guide: str, nuclease: str = "cas9") -> Locus:
    """A locus from sequences or FASTA files; a file of templates gives one for each record."""
    ref = text.sequence_or_file(spark, reference)
    own = {"hdr": templates.upper()} if re.fullmatch("[ACGTacgtNn]+", templates) else {r["name"]: r["sequence"] for r in text.fasta(spark, templates).collect()}
    return Locus(name, ref, own, guide, nuclease)


@dataclass
class Pipeline:
    locus: Locus
    samples: DataFrame | None
    output: str
    library: str | None
    contaminant: str | None


def pipeline(spark: SparkSession, source: str) -> Pipeline:
    """A run from the text of its YAML configuration."""
    data = yaml(source)
    at = data.get("locus") or {}
    locus = locus_of_files(spark, at.get("name", "unnamed"), at["reference"], at["hdr_template"], at.get("guide") or data.get("guide", ""), str(data.get("nuclease", "cas9")).lower())
    samples = tables.sample_key(spark, data["sample_key"]) if data.get("sample_key") else None
    contaminant = text.first_sequence(spark, data["contaminant"]) if data.get("contaminant") else None
    return Pipeline(locus, samples, data.get("output_dir", "./results"), data.get("library_type"), contaminant)


def tracks(spark: SparkSession, config: dict[str, str], left: tuple[int, int] | None = None, right: tuple[int, int] | None = None) -> DataFrame:
    """The genome and plasmid tracks of a barcode; the genome reads it turned. Loci are 1-based and closed there."""
    rows = []
    for name, key, turned in (("genome", "barcode_locus", True), ("plasmid", "plasmid_bc_locus", False)):
        if key in config:
            chrom, start, end = tables.locus(config[key])
            window = [*(left or (None, None)), *(right or (None, None))] if name == "genome" else [None] * 4
            rows.append((name, chrom, start - 1, end, turned, *window))
    return spark.createDataFrame(rows, "track string, rname string, bc_start int, bc_end int, turned boolean, left_lo int, left_hi int, right_lo int, right_hi int")


def check_track(reference: str, start: int, end: int, left: str, right: str) -> None:
    """Error unless a track's barcode (0-based, half-open) is all N in its contig and its flanks are as stated."""
    ref = reference.upper()
    if set(ref[start:end]) != {"N"}:
        raise ValueError("the barcode's place isn't all N in the reference")
    if not ref[:start].endswith(left.upper()) or not ref[end:].startswith(right.upper()):
        raise ValueError("the barcode's flanks aren't in the reference")


def batch_settings(samples: DataFrame, amplicon: str | None = None, guide: str | None = None, hdr: str | None = None, window: int = 10, least_identity: int = 70) -> DataFrame:
    """The settings table of another tool's batch mode; samples' own sequences go before the defaults."""
    own = lambda c, d: F.coalesce(F.col(c) if c in samples.columns else F.lit(None).cast("string"), F.lit(d or ""))
    columns = [F.col("sample_id").alias("name"), F.col("r1_path").alias("fastq_r1")]
    if "r2_path" in samples.columns:
        columns.append(F.coalesce("r2_path", F.lit("")).alias("fastq_r2"))
    columns += [own("amplicon_seq", amplicon).alias("amplicon_seq"), own("guide_seq", guide).alias("guide_seq")]
    if hdr or "hdr_seq" in samples.columns:
        columns.append(own("hdr_seq", hdr).alias("expected_hdr_amplicon_seq"))
    return samples.select(*columns, F.lit(window).alias("quantification_window_size"), F.lit(least_identity).alias("min_identity_score"))
