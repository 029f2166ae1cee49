"""Near copies by similarity: wide SimHash fingerprints in pigeonhole blocks, verified on the shingles.

A text's features are its distinct shingles of five words. Its fingerprint has 256 bits
over all of them, to compare, and blocks to find whom to compare with: block k is the
64-bit SimHash of the shingles in class k, of as many classes as leave about eight
shingles to each. Texts of similarity 0.8 differ in few shingles, so some class of the
two may have none of these: then they share a block, as by the pigeonhole. The first
`BLOCKS` classes are used, at the text's own number of classes and at twice that, so
that texts whose numbers differ by a step meet as well.

Pairs that share a block are joined, their Hamming distance is verified, and those
within `SLACK` standard deviations of what similarity 0.8 gives are decided by their
shingles. In a bucket of over `HOT` texts a member meets the bucket's centre only,
chosen by another hash in each bucket: thousands of near copies need a link to each
other, not all links.

What these links leave in different components is then compared exactly, so that
neither a block nor a distance loses a link. All texts order their shingles alike,
those common in the corpus last; two sets of similarity s share one of the first
n - ceil(s n) + 1 of each. Of the pairs that share one and aren't in one component yet,
those are left out that can't reach s: by what lies behind the shared shingle, and by
a bitmap of `FLAGS` bits that each shingle flips one of, as two bitmaps differ in no
more bits than their sets in shingles. As that one fills up in long texts, the pairs left
are compared by bitmaps that grow with the text. The rest is decided by the shingles of the two.
Shingles that the same texts hold among their first are paired once, those of over `PART` texts in salted blocks.

Texts that are equal after lower-casing A-Z and joining their words by spaces are one
node. Defined cases: texts without a word, null ones too, are equal texts; with fewer
than five words, the whole sequence is the one shingle. Rows without doc_id are kept.
Of repeated rows one stays; different texts under one doc_id are one document, and a
link of any of them is a link of it. An empty table gives an empty table. Columns may have any
names. A shingle is its 64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ampliscope.llm.common import discard, fresh, materialize, settle, ship, trimmed
from ampliscope.llm.components import connected_components
from ampliscope.llm.simhash import SEED

SHINGLE, SIMILARITY = 5, 0.8
WORDS = 4
BITS = 64 * WORDS
#: Standard deviations of the distance up to which pairs of a block are decided by their shingles.
SLACK = 3.0
#: Shingles of a class, about, and classes whose SimHash is a block.
CLASS, BLOCKS = 8, 8
HOT = 2
#: Texts of a shingle that one block pairs with as many others.
PART = 256
#: Bits of the bitmap that goes with every first shingle.
FLAGS = 1024
#: Counters of the shingles that are common; flags of the texts whose shingles are needed.
SLOTS = 1 << 20
ODD = np.uint64(0x9E3779B97F4A7C15)
#: Shingles that are hashed at a time.
CHUNK = 1 << 16


def most_bits(similarity: float, slack: float, bits: int = 1024) -> int:
    """The Hamming distance that sets of this Jaccard similarity have, and `slack` standard deviations."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(bits * p + slack * math.sqrt(bits * p * (1 - p)))


def _powers(n: int, known: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006  kept between calls
    """ODD^i and its inverse modulo 2^64, for i up to n at least."""
    if len(known.get("up", ())) <= n:
        size = max(1 << 12, 1 << n.bit_length())
        for name, base in (("up", int(ODD)), ("down", pow(int(ODD), -1, 1 << 64))):
            known[name] = np.concatenate(([np.uint64(1)], np.cumprod(np.full(size, base, np.uint64))))
    return known["up"], known["down"]


def _hashes(words: list[bytes], size: int) -> np.ndarray:
    """Of each run of `size` words, joined by spaces: a polynomial of its bytes modulo 2^64, mixed with its length."""
    line = np.frombuffer(b" ".join(words), np.uint8)
    spaces = np.flatnonzero(line == 32)
    starts, ends = np.concatenate(([0], spaces + 1)), np.concatenate((spaces, [len(line)]))
    up, down = _powers(len(line))
    sums = np.concatenate(([np.uint64(0)], np.cumsum((line.astype(np.uint64) + np.uint64(1)) * up[: len(line)])))
    a, b = starts[: len(words) - size + 1], ends[size - 1 :]
    return _mixed((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()  # of bytes: A-Z and the six ASCII spaces only


def _of_words(words: list[bytes], size: int) -> np.ndarray:
    """The distinct shingles, in order of their hashes."""
    size = min(size, len(words))
    parts = [_hashes(words[i : i + CHUNK + size - 1], size) for i in range(0, len(words) - size + 1, CHUNK)] if words else []
    return np.unique(np.concatenate([*parts, np.zeros(0, np.uint64)]))


def _features(text: bytes | None, size: int) -> np.ndarray:
    return _of_words(_words(text), size)


def _same(words: list[bytes]) -> str:
    return xxhash.xxh3_128_hexdigest(b" ".join(words), SEED)


def _mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: equal in, equal out, else unrelated."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _wide(h: np.ndarray) -> np.ndarray:
    """Of 256 bits of every shingle, those that over half have set: 4 words."""
    ones = np.zeros(BITS, np.int64)
    salt = np.arange(1, WORDS + 1, dtype=np.uint64) * ODD
    for i in range(0, len(h), 255):
        bits = np.unpackbits(_mixed(h[i : i + 255, None] + salt).view(np.uint8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.uint8)
    return np.packbits(ones * 2 > len(h), bitorder="little").view("<i8")


def _flags(h: np.ndarray, bits: int = FLAGS) -> np.ndarray:
    """A bitmap that every shingle flips one bit of. Its halves' difference is the one of half as many bits."""
    flips = np.bincount((h >> np.uint64(8)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(flips.astype(bool), bitorder="little").view("<i8")


def _wide_flags(h: np.ndarray) -> np.ndarray:
    """The bitmap of 2 to 4 bits for each shingle."""
    return _flags(h, max(FLAGS, 1 << (2 * len(h) - 1).bit_length()))


def _blocks(h: np.ndarray) -> np.ndarray:
    """The keys of the text's blocks, of the number of classes and the class with its SimHash."""
    keys = []
    level = max(0, math.ceil(math.log2(max(1, len(h)) / CLASS)))
    for lv in (level, level + 1):
        of = h & np.uint64((1 << lv) - 1)
        own = h[of < BLOCKS]
        of = (own & np.uint64((1 << lv) - 1)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        of, own = of[order], own[order]
        if not len(own):
            continue
        first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        size = np.diff(np.concatenate((first, [len(of)])))
        bits = np.unpackbits(_mixed(own).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        block = np.packbits(ones * 2 > size[:, None], axis=1, bitorder="little").view("<u8").ravel()
        keys.append(_mixed(block + (of[first] + lv * BLOCKS + 1).astype(np.uint64) * ODD))
    return np.concatenate([*keys, np.zeros(0, np.uint64)]).view(np.int64)


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(44)).astype(np.int64)


SKETCH = "doc_id long, text_hash string, bits array<long>, blocks array<long>, slot long, n long"


def _sketches(size: int):
    """A row for each text; and at a task's end (slot, n) of its shingles where n stands out from what chance puts in a slot."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.string()), ("bits", pa.list_(pa.int64())), ("blocks", pa.list_(pa.int64())), ("slot", pa.int64()), ("n", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(SLOTS, np.int32)
        for batch in batches:
            same, bits, blocks = [], [], []
            for cell in batch.column(1).cast(pa.binary()):
                words = _words(cell.as_py())
                h = _of_words(words, size)
                seen[_slot(h)] += 1
                same.append(_same(words)), bits.append(_wide(h)), blocks.append(_blocks(h))
            none = pa.nulls(len(same), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(same, pa.string()), pa.array(bits, schema.field("bits").type), pa.array(blocks, schema.field("blocks").type), none, none], schema=schema)
        mean = seen.mean()
        slots = np.flatnonzero(seen > mean + 4 * math.sqrt(mean) + 2)
        for i in range(0, len(slots), CHUNK):
            part = slots[i : i + CHUNK]
            yield pa.RecordBatch.from_arrays([*(pa.nulls(len(part), f.type) for f in list(schema)[:4]), pa.array(part, pa.int64()), pa.array(seen[part], pa.int64())], schema=schema)

    return rows


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def _shingles(size: int, needed: np.ndarray, of=lambda h: h.view(np.int64)):
    """The number of shingles of the texts whose flag is needed, and the shingles or what `of` makes of them."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(needed[batch.column(2).to_numpy()]))
            sets = [_features(cell.as_py(), size) for cell in batch.column(1).cast(pa.binary())]
            made = pa.array([of(h) for h in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(h) for h in sets], pa.int32()), made], names=["rep", "n", "shingles"])

    return rows


def _prefixes(size: int, similarity: float, slots: np.ndarray, counts: np.ndarray):
    """Of every text the bitmap, and the first shingles by how common they are, that a similar text can't be without."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.zeros(SLOTS, np.int64)
        often[slots] = counts
        for batch in batches:
            same, sizes, flags, firsts = [], [], [], []
            for cell in batch.column(1).cast(pa.binary()):
                words = _words(cell.as_py())
                h = _of_words(words, size)
                least = math.ceil(similarity * len(h) - 1e-6)
                same.append(_same(words)), sizes.append(len(h)), flags.append(_flags(h))
                firsts.append(h[np.lexsort((h, often[_slot(h)]))[: len(h) - least + 1]].view(np.int64))
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (flags, firsts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(same, pa.string()), pa.array(sizes, pa.int32()), *lists], names=["rep", "text_hash", "size", "flags", "firsts"])

    return rows


def _differ(x: str, y: str, words: int):
    """The bits in which two arrays of longs differ."""
    each = [F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(words)]
    return sum(each[1:], each[0])


def _by_blocks(same: DataFrame, similarity: float) -> DataFrame:
    """(a, b): pairs of a block that are near by Hamming distance; in large buckets, of the centre and a member."""
    keyed = same.select("rep", F.explode("blocks").alias("k"))
    shared = materialize(keyed.groupBy("k").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    within = keyed.join(shared.hint("shuffle_hash"), "k").join(same.select("rep", "bits"), "rep")
    within = materialize(within, "candidates")
    near = _differ("x", "y", WORDS) <= most_bits(similarity, SLACK, BITS)
    one = within.select("k", F.col("rep").alias("a"), F.col("bits").alias("x"), "n")
    two = within.select("k", F.col("rep").alias("b"), F.col("bits").alias("y"))
    all_pairs = one.where(F.col("n") <= HOT).join(two, "k").where((F.col("a") < F.col("b")) & near).select("a", "b")
    centre = one.where(F.col("n") > HOT).groupBy("k").agg(F.min_by(F.struct("a", "x"), F.xxhash64("a", "k")).alias("c")).select("k", "c.*")
    centre = materialize(centre, "centres")
    star = two.join(centre, "k").where((F.col("a") != F.col("b")) & near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    found = materialize(all_pairs.unionByName(star).distinct(), "near")
    for gone in (shared, within, centre):
        discard(gone)
    return found


def _unmet(docs: DataFrame, same: DataFrame, common: DataFrame, found: DataFrame, size: int, similarity: float) -> DataFrame:
    """(a, b): every pair of different components of found that may be similar, by a shared first shingle."""
    # at most SLOTS rows, whatever the input
    counted = common.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    firsts = _prefixes(size, similarity, counted["slot"].to_numpy(), counted["n"].to_numpy())
    rows = _plain(docs).where("doc_id is not null").mapInArrow(trimmed(firsts), "rep long, text_hash string, size int, flags array<long>, firsts array<long>")
    rows = rows.join(same.select("rep", "text_hash").hint("shuffle_hash"), ["rep", "text_hash"], "left_semi").dropDuplicates(["rep", "text_hash"])
    rows = rows.join(found.select(F.col("node").alias("rep"), F.col("component").alias("of")).hint("shuffle_hash"), "rep", "left")
    rows = materialize(rows.withColumn("of", F.coalesce("of", "rep")), "firsts")
    keyed = rows.select("rep", F.posexplode("firsts").alias("at", "k"))
    of_key = rows.select("rep", "of", F.explode("firsts").alias("k")).groupBy("k").agg(F.count("*").alias("n"), F.min("of").alias("least"), F.max("of").alias("most"), F.bit_xor("rep").alias("reps"))
    # shingles of the same texts, as those of a passage, are one: the first of each text; lists that only hash alike may be
    shared = materialize(of_key.where("least < most").select("k", "n", F.xxhash64("n", "least", "most", "reps").alias("same")), "buckets")
    keyed = keyed.join(shared.hint("shuffle_hash"), "k").select("rep", F.col("same").alias("k"), "n", "at")
    within = keyed.repartition("rep").groupBy("rep", "k", "n").agg(F.min("at").alias("at")).join(rows.select("rep", "of", "size", "flags"), "rep")
    # every text of a part meets every part of its shingle
    parts = F.ceil(F.col("n") / PART).cast("int")
    within = materialize(within.withColumns({"parts": parts, "p": F.pmod(F.xxhash64("rep"), parts).cast("int"), "left": F.col("size") - F.col("at")}), "candidates")
    every = within.withColumn("q", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    names = lambda **to: [F.col(c).alias(new) for c, new in to.items()]
    one = every.select("k", "p", "q", *names(rep="a", of="_a", size="m", left="x", flags="f"))
    two = every.select("k", *names(q="p", p="q", rep="b", of="_b", size="l", left="y", flags="g"))
    both = F.col("m") + F.col("l")
    # the first shared shingle and those behind it are all that two can have in common
    enough = F.least("x", "y") >= both * (similarity / (1 + similarity)) - 1e-6
    alike = _differ("f", "g", FLAGS // 64) <= both * ((1 - similarity) / (1 + similarity)) + 1e-6
    pairs = one.join(two, ["k", "p", "q"]).where((F.col("a") < F.col("b")) & (F.col("_a") != F.col("_b")) & enough & alike).select("a", "b")
    found = materialize(pairs.distinct(), "unmet")
    for gone in (rows, shared, within):
        discard(gone)
    return found


def _sets(docs: DataFrame, pairs: DataFrame, size: int, **of) -> DataFrame:
    """(rep, n, shingles) of every text of pairs, as a table; `of` as in _shingles()."""
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(SLOTS)).cast("int")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("rep"))
    # at most SLOTS rows, whatever the input; texts without a flag aren't read further
    needed = np.zeros(SLOTS, bool)
    needed[ends.select(slot(F.col("rep")).alias("slot")).distinct().toArrow()["slot"].to_numpy()] = True
    texts = _plain(docs).where("doc_id is not null").withColumn("slot", slot(F.col("doc_id")))
    return materialize(texts.mapInArrow(trimmed(_shingles(size, needed, **of)), "rep long, n int, shingles array<long>"), "shingles")


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, m, l, x, y): the pairs with what _sets() holds of both."""
    left = pairs.join(sets.select(F.col("rep").alias("a"), F.col("n").alias("m"), F.col("shingles").alias("x")), "a")
    return left.join(sets.select(F.col("rep").alias("b"), F.col("n").alias("l"), F.col("shingles").alias("y")), "b")


def _hopeful(docs: DataFrame, pairs: DataFrame, size: int, similarity: float) -> DataFrame:
    """The pairs (a, b) that sizes and wide bitmaps leave."""
    sets = _sets(docs, pairs, size, of=_wide_flags)
    half = lambda c: (F.size(c) / 2).cast("int")
    xor = lambda x, y: F.zip_with(x, y, lambda v, w: v.bitwiseXOR(w))
    halved = lambda c: xor(F.slice(c, F.lit(1), half(c)), F.slice(c, half(c) + 1, half(c)))
    both = _with_sets(pairs, sets).where(F.least("m", "l") >= similarity * F.greatest("m", "l") - 1e-6)
    x, y = F.col("x"), F.col("y")
    both = both.withColumns({"x": F.when(F.size(x) > F.size(y), halved(x)).otherwise(x), "y": F.when(F.size(y) > F.size(x), halved(y)).otherwise(y)})
    bits = F.aggregate(F.transform(xor(x, y), lambda v: F.bit_count(v).cast("int")), F.lit(0), lambda n, v: n + v)
    # sizes more than a step apart, as a similarity under 1/2 allows, aren't compared
    alike = (F.size(x) != F.size(y)) | (bits <= (F.col("m") + F.col("l")) * ((1 - similarity) / (1 + similarity)) + 1e-6)
    left = materialize(both.where(alike).select("a", "b").distinct(), "hopeful")
    discard(sets)
    return left


def _similar(docs: DataFrame, pairs: DataFrame, size: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets of shingles are as similar."""
    sets = _sets(docs, pairs, size)
    common = F.size(F.array_intersect("x", "y"))
    both = _with_sets(pairs, sets)
    similar = materialize(both.where(common >= similarity * (F.col("m") + F.col("l") - common) - 1e-9).select("a", "b").distinct(), "similar")
    discard(sets)
    return similar


def components(docs: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, component_id) for every document with a doc_id; the component is its smallest doc_id."""
    spark = docs.sparkSession
    ship(spark)
    sketched = materialize(_plain(docs).where("doc_id is not null").mapInArrow(trimmed(_sketches(size)), SKETCH), "sketches")
    texts, common = sketched.where("slot is null"), sketched.where("slot is not null").select("slot", "n")
    same = materialize(texts.groupBy("text_hash").agg(F.min("doc_id").alias("rep"), F.first("bits").alias("bits"), F.first("blocks").alias("blocks")), "texts")
    near = _similar(docs, _by_blocks(same, similarity), size, similarity)
    settle(spark)
    found = connected_components(near, "a", "b")
    settle(spark)
    unmet = _unmet(docs, same, common, found, size, similarity)
    settle(spark)
    if not unmet.isEmpty():
        hopeful = _hopeful(docs, unmet, size, similarity)
        discard(unmet)
        settle(spark)
        found = connected_components(near.unionByName(_similar(docs, hopeful, size, similarity)), "a", "b")
        settle(spark)
    label = same.join(found, same["rep"] == found["node"], "left").select("text_hash", F.coalesce("component", "rep").alias("component_id"))
    return texts.select("doc_id", "text_hash").join(materialize(label, "labels"), "text_hash").select("doc_id", "component_id")


def one_of_each(docs: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """The documents, all columns, less those that are near copies of one with a smaller doc_id."""
    found = materialize(components(docs, size, similarity), "components")
    gone, row = fresh(docs, "gone"), fresh(docs, "row")
    away = found.where("component_id < doc_id").select(F.col("doc_id").alias(gone)).distinct()
    left = docs.join(away.hint("shuffle_hash"), docs["doc_id"] == F.col(gone), "left_anti")
    if found.groupBy("doc_id").count().where("count > 1").isEmpty():
        return left
    once = Window.partitionBy("doc_id").orderBy(F.length("text"), "text")
    again = left.where("doc_id is not null").withColumn(row, F.row_number().over(once)).where(F.col(row) == 1).drop(row)
    return again.unionByName(left.where("doc_id is null"))
