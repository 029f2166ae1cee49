"""Mixing sources to target weights by hierarchical budgeting, in DataFrame operations only.

The token budget goes down a domain-language-source tree. At each node it is shared
among the children by weight; a child that can't use its share (its tokens times the
allowed epochs are fewer) leaves the rest to its siblings, and only what all of them
can't use goes back to the level above, as a node's share never exceeds what its
leaves can use. A leaf takes whole epochs and then, of one more epoch in the order
of a seeded hash, the longest prefix that fits.

A third of all rows may be one leaf: its prefix is found from sums by hash bucket, then
by parts of the bucket in which it ends, and only rows of the part in which it ends are
put in order: a leaf of 10^10 rows is about 600 rows there.

Defined cases: a null lang or source is its own child, `und` and `unknown`; a null
text has no tokens. Documents without tokens go wherever their place in the order
is. Equal rows are ordered by doc_id, then tokens; which of several equal rows is
taken doesn't matter. A leaf of weight 0 gets nothing. An empty table gives an empty
table. Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampliscope.llm.common import materialize

SEED = 17
MAX_EPOCHS = 4
#: The budget as a part of the documents' tokens.
BUDGET = 0.8
#: Domains of sources by the last digit of their name, and whole-number weights.
DOMAIN_OF_DIGIT = {"0": "web", "1": "web", "2": "web", "3": "web", "4": "books", "5": "books", "6": "forum", "7": "forum", "8": "news", "9": "news"}
DOMAIN_WEIGHTS = {"web": 400, "books": 300, "forum": 100, "news": 200}
LANG_WEIGHTS = {"en": 400, "de": 200, "fr": 200, "es": 200}
#: Weight of a domain, language or source that isn't named.
OTHER = 100
SOURCE_WEIGHTS = {"src0": 200}
#: Leading hex digits of the order key that a bucket shares, and a part of one.
DIGITS = (3, 6)
#: Leaves up to this many are broadcast; more are joined by shuffle.
MOST_BROADCAST = 20_000

WORD = r"[^ \t\n\x0B\f\r]+"
LEAF = ["domain", "lang", "source"]


@dataclass(frozen=True)
class Tree:
    """Target weights at each level, and the domain of a source by its last digit; what isn't named weighs `other`."""

    domain_of_digit: dict[str, str] = field(default_factory=lambda: DOMAIN_OF_DIGIT)
    domains: dict[str, int] = field(default_factory=lambda: DOMAIN_WEIGHTS)
    langs: dict[str, int] = field(default_factory=lambda: LANG_WEIGHTS)
    sources: dict[str, int] = field(default_factory=lambda: SOURCE_WEIGHTS)
    other: int = OTHER


TREE = Tree()


def _weight(column: str, weights: dict[str, int], other: int) -> Column:
    if not weights:
        return F.lit(float(other))
    table = F.create_map(*(F.lit(x) for kv in weights.items() for x in kv))
    return F.coalesce(F.element_at(table, F.col(column)), F.lit(other)).cast("double")


def _fill(nodes: DataFrame, parent: list[str], child: str, budget: str, weight: Column) -> DataFrame:
    """nodes with `share`: their parent's budget by weight, none over its cap, what is over going to siblings."""
    order = Window.partitionBy(*parent).orderBy("ratio", child)
    weighed = nodes.withColumn("w", weight).withColumn("ratio", F.when(F.col("w") > 0, F.col("cap") / F.col("w")).otherwise(F.lit(0.0)))
    below = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = weighed.where("w > 0").withColumn("level", (F.col(budget) - below) / rest)
    level = level.withColumn("level", F.max("level").over(Window.partitionBy(*parent)))
    return level.withColumn("share", F.least(F.col("cap"), F.col("level") * F.col("w"))).drop("w", "ratio", "level")


def budgets(leaves: DataFrame, part: float = BUDGET, max_epochs: int = MAX_EPOCHS, tree: Tree = TREE) -> DataFrame:
    """leaves (domain, lang, source, tokens) with whole epochs and the tokens of the last, partial one."""
    total = leaves.agg(F.sum("tokens")).first()[0] or 0  # one number
    capped = leaves.withColumn("cap", (F.col("tokens") * max_epochs).cast("double")).withColumn("budget", F.lit(float(math.floor(float(total) * part))))
    domains = capped.groupBy("domain").agg(F.sum("cap").alias("cap"), F.max("budget").alias("budget")).withColumn("top", F.lit(1))
    domains = _fill(domains, ["top"], "domain", "budget", _weight("domain", tree.domains, tree.other)).select("domain", F.col("share").alias("of_domain"))
    langs = capped.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).join(domains, "domain")
    langs = _fill(langs, ["domain"], "lang", "of_domain", _weight("lang", tree.langs, tree.other)).select("domain", "lang", F.col("share").alias("of_lang"))
    final = _fill(capped.join(langs, ["domain", "lang"]), ["domain", "lang"], "source", "of_lang", _weight("source", tree.sources, tree.other))
    whole = F.floor(F.col("share"))
    return final.select(*LEAF, "tokens", whole.alias("target")).withColumn("epochs", F.expr("CASE WHEN tokens > 0 THEN target div tokens ELSE 0 END")).withColumn("part", F.col("target") - F.col("epochs") * F.col("tokens"))


def _leaf(tree: Tree) -> list[Column]:
    digit = F.element_at(F.create_map(*(F.lit(x) for kv in tree.domain_of_digit.items() for x in kv)), F.right(F.col("source"), F.lit(1))) if tree.domain_of_digit else F.lit(None)
    words = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    return [F.coalesce(digit, F.lit("other")).alias("domain"), F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("source", F.lit("unknown")).alias("source"), words.alias("n_tokens")]


def sized(docs: DataFrame, tree: Tree = TREE) -> DataFrame:
    """doc_id, leaf and tokens (words) of every document."""
    return docs.select("doc_id", *_leaf(tree))


def _copies(rows: DataFrame, sizes: DataFrame, part: float, max_epochs: int, seed: int, tree: Tree) -> DataFrame:
    """rows (with doc_id, leaf and n_tokens) that the mixture holds, with `copies`; sizes: the same of a small table."""
    leaves = materialize(sizes.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    plan = materialize(budgets(leaves, part, max_epochs, tree).select(*LEAF, "epochs", "part"), "budgets")
    few = F.broadcast if plan.count() <= MOST_BROADCAST else lambda x: x
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("epochs").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    keyed = lambda t: t.join(few(plan), LEAF).withColumn("key", key)
    inside, cut, depth = keyed(sizes).withColumn("before", F.lit(0).cast("long")), None, 0
    for digits in DIGITS:
        sums = inside.groupBy(*LEAF, F.substring("key", 1, digits).alias("bucket")).agg(F.sum("n_tokens").alias("n"), F.first("part").alias("part"), F.first("before").alias("before"))
        upto = F.col("before") + F.sum("n").over(Window.partitionBy(*LEAF).orderBy("bucket"))  # 4,096 rows of a leaf at most
        # the bucket in which a leaf's prefix ends, and the tokens before it
        cut = sums.withColumn("upto", upto).where("upto > part").groupBy(*LEAF).agg(F.min(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before"))).alias("cut"))
        cut = materialize(cut.select(*LEAF, "cut.before", F.col("cut.bucket").alias("cut")), "cuts")
        inside = keyed(sizes).join(few(cut), LEAF).where(F.substring("key", 1, digits) == F.col("cut"))
        depth = digits
    placed = keyed(rows).join(few(cut), LEAF, "left").withColumn("bucket", F.substring("key", 1, depth))
    run = F.sum("n_tokens").over(Window.partitionBy(*LEAF).orderBy("key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, 0))
    ends = placed.where("bucket = cut").withColumn("more", F.col("before") + run <= F.col("part"))
    others = placed.where("cut is null or bucket != cut").withColumn("more", F.coalesce(F.col("bucket") < F.col("cut"), F.lit(True)))
    out = others.unionByName(ends).withColumn("copies", (F.col("epochs") + F.col("more").cast("int")).cast("int"))
    return out.where("copies > 0").select(*rows.columns, "copies")


def mix(docs: DataFrame, part: float = BUDGET, max_epochs: int = MAX_EPOCHS, seed: int = SEED, tree: Tree = TREE) -> DataFrame:
    """How many copies of every document the mixture holds, for those that it holds."""
    rows = materialize(sized(docs, tree), "sized")
    return _copies(rows, rows, part, max_epochs, seed, tree).select("doc_id", *LEAF, "n_tokens", "copies")


def mixture(docs: DataFrame, part: float = BUDGET, max_epochs: int = MAX_EPOCHS, seed: int = SEED, tree: Tree = TREE) -> DataFrame:
    """The documents of the mixture, each row as often as it holds it. The texts aren't shuffled but for the
    buckets in which prefixes end."""
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "doc_id", *_leaf(tree))
    held = _copies(whole, materialize(sized(docs, tree), "sized"), part, max_epochs, seed, tree)
    return held.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


def _case(column: str, table: dict, other) -> str:
    quoted = lambda v: f"'{v}'" if isinstance(v, str) else v
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {quoted(v)}" for k, v in table.items()) + f" ELSE {quoted(other)} END"


def _filled(parent: str, child: str, budget: str, source: str) -> str:
    return f"""SELECT *, least(cap, max(level) OVER (PARTITION BY {parent}) * w) AS share FROM (
  SELECT *, ({budget} - coalesce(sum(cap) OVER (PARTITION BY {parent} ORDER BY ratio, {child} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (PARTITION BY {parent} ORDER BY ratio, {child} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM (SELECT *, cap / w AS ratio FROM ({source})))"""


SQL = f"""
WITH sized AS (SELECT doc_id, {_case("right(source, 1)", DOMAIN_OF_DIGIT, "other")} AS domain, coalesce(lang, 'und') AS lang, coalesce(source, 'unknown') AS source,
  coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+')), 0) AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens)::DOUBLE * {MAX_EPOCHS} AS cap FROM sized GROUP BY ALL),
total AS (SELECT floor(sum(tokens)::DOUBLE * {BUDGET}::DOUBLE) AS budget FROM leaves),
domains AS ({_filled("top", "domain", "budget", f"SELECT domain, sum(cap) AS cap, 1 AS top, {_case('domain', DOMAIN_WEIGHTS, OTHER)}::DOUBLE AS w, any_value(budget) AS budget FROM leaves, total GROUP BY domain")}),
langs AS ({_filled("domain", "lang", "of_domain", f"SELECT l.domain, l.lang, sum(l.cap) AS cap, any_value(d.share) AS of_domain, {_case('l.lang', LANG_WEIGHTS, OTHER)}::DOUBLE AS w FROM leaves l JOIN domains d USING (domain) GROUP BY l.domain, l.lang")}),
finals AS ({_filled("domain, lang", "source", "of_lang", f"SELECT l.domain, l.lang, l.source, l.tokens, l.cap, g.share AS of_lang, {_case('l.source', SOURCE_WEIGHTS, OTHER)}::DOUBLE AS w FROM leaves l JOIN langs g USING (domain, lang)")}),
plan AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN floor(share)::BIGINT // tokens ELSE 0 END AS epochs, CASE WHEN tokens > 0 THEN floor(share)::BIGINT % tokens ELSE floor(share)::BIGINT END AS part FROM finals),
keyed AS (SELECT s.*, p.epochs, p.part, md5('{SEED}|' || p.epochs || '|' || coalesce(doc_id::VARCHAR, '')) AS key FROM sized s JOIN plan p USING (domain, lang, source)),
run AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key, doc_id, n_tokens ROWS UNBOUNDED PRECEDING) <= part AS more FROM keyed)
SELECT doc_id, domain, lang, source, n_tokens, (epochs + more::INT)::INT AS copies FROM run WHERE epochs + more::INT > 0"""
