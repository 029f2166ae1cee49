"""Token-id files: an adaptive context-mixing range coder over independently reset blocks.

Three orders predict the next id: orders 2 and 1 the id that their context (the last
two ids, the last one) points to, order 0 every id of the block so far in proportion
to its count. A fourth share is for an id that is new to the block, coded as it is.
The four shares are mixed by weights that adapt to how far each order can be trusted
(its confidence here, and whether orders 2 and 1 agree); the mixture drives a range
coder. An id goes out under the highest order that predicts it, and order 0 counts
only what reaches it.

A block starts from nothing, so the blocks of a segment are coded side by side, one
numpy lane each; the state of a lane is a few hundred kB. All numbers of the coder
are whole and below 2^53, held as doubles: a range of at least 2^32 and below 2^48,
shifted by 16 bits at a time.

A segment (a record of a file) is

    AXR2, then as unsigned 32-bit: ids, lanes, ids a lane, documents
    as 64-bit: ids of the file's part before this segment
    CRC-32 of the header and the tables
    for each document: doc_id (64-bit), ids (32-bit), 1 if doc_id is null (8-bit)
    for each lane: 16-bit words, CRC-32 of the words, CRC-32 of the ids (each 32-bit)
    then the words of all lanes

all little-endian. A lane is a block: it is decoded without the others
(`decode_blocks`), and a damaged one is found and costs its own ids only. Segments
start and end with documents. The files are Parquet
tables with a row for each segment, so that they can be written, committed and read
in any store that Spark reaches.

The lanes here define the format and open single blocks. Whole tables are written and
read by TokenCoder.java beside this file, block after block, at about a tenth of the
time; it gives the same bytes.

Defined cases: a null or empty text has the end id only. Rows with equal doc_id are
ordered by text and may go to several parts; a null doc_id comes first. An empty table gives an empty table.
Other columns are not read. Ids must be below 65536.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ampliscope.llm.common import begin_of, materialize, ship, slices, utf8
from ampliscope.llm.tokens import encoder, vocabulary_path
from ampliscope.runtime import java_function

MAGIC = b"AXR2"
END_ID = 2
#: Ids of a block, and of a segment at least, if there are so many.
BLOCK, SEGMENT = 8192, 4 << 20
#: Blocks of a segment at least, unless they would be shorter than this.
LANES, SHORT = 512, 2048
#: log2 of the slots of orders 1 and 2.
SLOTS_1, SLOTS_2 = 12, 13
#: The ids of a block that order 0 tells apart: SIDE groups of SIDE.
SIDE = 64
COUNT = 6
#: What a weight gains, and the sum at which weights are halved.
GAIN, MOST = 24, 4000
WORD, LOW = 65536.0, 2.0**32
#: Shares of orders 2, 1, 0 and of new ids at first, by confidence of orders 2 and 1 and agreement.
FIRST = np.array([[16 * n2, 8 * n1 * (1 - agree), 8, 8] for agree in (0, 1) for n2 in range(4) for n1 in range(4)], dtype=np.int64)
STATES = len(FIRST)


#: What a count adds to the sums above it, for each place.
ABOVE = np.triu(np.full((SIDE, SIDE + 1), COUNT, np.uint16), 1)


class Lanes:
    """The models of blocks that are coded side by side."""

    def __init__(self, n: int):
        self.lane = np.arange(n)
        self.slots_1, self.slots_2 = np.zeros(n << SLOTS_1, np.int32), np.zeros(n << SLOTS_2, np.int32)
        self.at_1, self.at_2, self.at_state = self.lane << SLOTS_1, self.lane << SLOTS_2, self.lane * STATES
        # the four shares one after the other
        self.each = n * STATES
        self.weights = np.tile(FIRST, (n, 1)).T.ravel().copy()
        # counts of order 0 as sums up to each group, and up to each id of a group; under 2^16 in a block
        self.groups = np.zeros((n, SIDE + 1), np.uint16)
        self.within = np.zeros((n * SIDE, SIDE + 1), np.uint16)
        self.at_group = self.lane * SIDE
        self.size = np.zeros(n, np.int64)
        self.last, self.before = np.zeros(n, np.int64), np.zeros(n, np.int64)

    def predict(self) -> None:
        """The ids that orders 1 and 2 point to, the four shares and where each begins."""
        self.i1 = self.at_1 + ((self.last * 40503 >> 4) & ((1 << SLOTS_1) - 1))
        self.i2 = self.at_2 + (((self.last * 0x9E3779B1 + self.before * 0x85EBCA77) >> 15) & ((1 << SLOTS_2) - 1))
        s1, s2 = self.slots_1.take(self.i1), self.slots_2.take(self.i2)
        self.n1, self.n2, self.id1, self.id2 = s1 & 3, s2 & 3, s1 >> 2, s2 >> 2
        self.state = self.at_state + (self.n2 << 2) + self.n1 + (((self.id1 == self.id2) & (self.n2 > 0)) << 4)
        w = [self.weights.take(self.state + k * self.each) for k in range(4)]
        two, three = w[0] + w[1], w[0] + w[1] + w[2]
        self.shares, self.begins, self.total = w, (0, w[0], two, three), three + w[3]

    def update(self, ids: np.ndarray, share: np.ndarray, index: np.ndarray) -> None:
        """ids: what came, in which share, and its number in the block's order of first use (SIDE^2 or more: not counted)."""
        self.weights[share * self.each + self.state] += GAIN
        full = np.flatnonzero(self.total > MOST)
        if len(full):
            for k in range(4):
                at = self.state[full] + k * self.each
                self.weights[at] = (self.weights[at] + 1) >> 1
        for slots, at, n, old in ((self.slots_1, self.i1, self.n1, self.id1), (self.slots_2, self.i2, self.n2, self.id2)):
            hit = (old == ids) & (n > 0)
            n_new = np.where(hit, np.minimum(n + 1, 3), np.maximum(n - 1, 1))
            slots[at] = (np.where(hit | (n > 1), old, ids) << 2) | n_new
        counted = np.flatnonzero((share >= 2) & (index < SIDE * SIDE))
        if len(counted):
            index = index[counted]
            group = index >> 6
            self.groups[counted] += ABOVE.take(group, axis=0)
            self.within[self.at_group[counted] + group] += ABOVE.take(index & (SIDE - 1), axis=0)
        self.before, self.last = self.last, ids


def first_use(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each id of each lane: its number in the lane's order of first use, and whether this is its first use."""
    index, first = np.empty(ids.shape, np.int64), np.empty(ids.shape, bool)
    steps, seen = np.arange(ids.shape[1]), np.zeros(65536, np.int64)
    for k, row in enumerate(ids):
        seen[row[::-1]] = steps[::-1]
        at = seen[row]
        first[k] = at == steps
        index[k] = (np.cumsum(first[k]) - 1)[at]
    return index, first


def encode_lanes(ids: np.ndarray) -> list[np.ndarray]:
    """The 16-bit words of each lane of ids (lanes x ids)."""
    lanes, steps = ids.shape
    if steps * COUNT >= 65536:
        raise ValueError("a block's counts must stay below 2^16")
    ids = ids.astype(np.int64)
    index, first = first_use(ids)
    unknown = np.ascontiguousarray((first | (index >= SIDE * SIDE)).T)
    ids, index = np.ascontiguousarray(ids.T), np.ascontiguousarray(index.T)
    model = Lanes(lanes)
    low, width = np.zeros(lanes), np.full(lanes, 2.0**48 - 1)
    out, filled = np.zeros((lanes, 2 * steps + 4), np.int32), np.zeros(lanes, np.int64)

    def put(start: np.ndarray, size: np.ndarray, total: np.ndarray) -> None:
        nonlocal low, width
        unit = np.floor(width / total)
        low = low + start * unit
        width = size * unit
        short = np.flatnonzero(width < LOW)
        if len(short):
            word = np.floor(low[short] / LOW)
            # up to 17 bits: what is carried is added to the word before in the end
            out[short, filled[short]] = word
            filled[short] += 1
            low[short] = (low[short] - word * LOW) * WORD
            width[short] *= WORD

    lane, one = model.lane, np.ones(lanes, np.int64)
    for t in range(steps):
        x, i = ids[t], index[t]
        model.predict()
        share = np.where(unknown[t], 3, 2)
        share[(model.id1 == x) & (model.n1 > 0)] = 1
        share[(model.id2 == x) & (model.n2 > 0)] = 0
        put(np.choose(share, model.begins), np.choose(share, model.shares), model.total)
        i0 = np.minimum(i, SIDE * SIDE - 1)
        group, place = i0 >> 6, i0 & (SIDE - 1)
        at = model.at_group + group
        below = model.within[at, place].astype(np.int64)
        known = share == 2
        start = np.choose(share, (0, 0, model.groups[lane, group] + below, x))
        size = np.where(known, model.within[at, place + 1] - below, one)
        put(start, size, np.choose(share, (1, 1, model.groups[:, SIDE].astype(np.int64), 65536)))
        model.update(x, share, i)
    for _ in range(3):  # the whole of low
        word = np.floor(low / LOW)
        out[model.lane, filled] = word
        filled += 1
        low = (low - word * LOW) * WORD
    for k in range(int(filled.max()) - 1, 0, -1):
        out[:, k - 1] += out[:, k] >> 16
        out[:, k] &= 0xFFFF
    return [out[k, : filled[k]].astype("<u2") for k in range(lanes)]


def decode_lanes(words: list[np.ndarray], steps: int) -> np.ndarray:
    """The ids (lanes x ids) of encode_lanes()."""
    lanes = len(words)
    model, ids = Lanes(lanes), np.empty((steps, lanes), np.int64)
    known = np.zeros((lanes, SIDE * SIDE), np.int64)
    at = np.zeros(lanes, np.int64)
    at[1:] = np.cumsum([len(w) + 4 for w in words])[:-1]
    flat = np.concatenate([np.concatenate((w, np.zeros(4, "<u2"))) for w in words]).astype(np.float64)
    code = (flat[at] * WORD + flat[at + 1]) * WORD + flat[at + 2]
    at += 3
    width = np.full(lanes, 2.0**48 - 1)

    def take(start: np.ndarray, size: np.ndarray, unit: np.ndarray) -> None:
        nonlocal code, width
        code = code - start * unit
        width = size * unit
        short = np.flatnonzero(width < LOW)
        if len(short):
            code[short] = code[short] * WORD + flat[at[short]]
            at[short] += 1
            width[short] *= WORD

    lane = model.lane
    for t in range(steps):
        model.predict()
        unit = np.floor(width / model.total)
        value = np.floor(code / unit)
        _, b1, b2, b3 = model.begins
        share = (value >= b1).astype(np.int64) + (value >= b2) + (value >= b3)
        take(np.choose(share, model.begins), np.choose(share, model.shares), unit)
        two, three = share == 2, share == 3
        unit = np.floor(width / np.choose(share, (1, 1, model.groups[:, SIDE].astype(np.int64), 65536)))
        value = np.floor(code / unit).astype(np.int64)
        # the first sum above the value; in other shares it doesn't matter
        group = (model.groups[:, 1:] > np.where(two, value, 0).astype(np.uint16)[:, None]).argmax(1)
        above = model.groups[lane, group].astype(np.int64)
        own = model.within.take(model.at_group + group, axis=0)
        place = (own[:, 1:] > np.where(two, value - above, 0).astype(np.uint16)[:, None]).argmax(1)
        below = own[lane, place].astype(np.int64)
        number = (group << 6) + place
        index = np.where(two, number, model.size)
        take(np.choose(share, (0, 0, above + below, value)), np.where(two, own[lane, place + 1] - below, 1), unit)
        x = np.choose(share, (model.id2, model.id1, known[lane, number], value))
        new = np.flatnonzero(three & (model.size < SIDE * SIDE))
        known[new, model.size[new]] = x[new]
        model.size[new] += 1
        model.update(x, share, index)
        ids[t] = x
    return ids.T


HEADER = struct.Struct("<4s4IqI")
DOCUMENT = np.dtype([("doc_id", "<i8"), ("ids", "<u4"), ("null", "u1")])
LANE = np.dtype([("words", "<u4"), ("words_crc", "<u4"), ("ids_crc", "<u4")])
#: What Decode tells of a document.
INDEX = np.dtype([("doc_id", "<i8"), ("start", "<i8"), ("ids", "<u4"), ("ids_crc", "<u4"), ("null", "u1")])


def encode_segment(docs: list[tuple[int | None, np.ndarray]], before: int = 0) -> bytes:
    """The record of documents (doc_id, ids); before: the ids of the file's part before it."""
    ids = np.concatenate([x for _, x in docs]).astype("<u4")
    if len(ids) and int(ids.max()) >= 65536:
        raise ValueError("ids must be below 65536")
    table = np.array([(0 if d is None else d, len(x), d is None) for d, x in docs], dtype=DOCUMENT).tobytes()
    lanes = max(1, -(-len(ids) // BLOCK), min(LANES, len(ids) // SHORT)) if len(ids) else 0
    steps = -(-len(ids) // lanes) if lanes else 0
    padded = np.zeros((lanes, steps), "<u4")
    padded.ravel()[: len(ids)] = ids
    words = encode_lanes(padded) if lanes else []
    each = np.array([(len(w), zlib.crc32(w.tobytes()), zlib.crc32(x.tobytes())) for w, x in zip(words, padded)], dtype=LANE).tobytes()
    head = HEADER.pack(MAGIC, len(ids), lanes, steps, len(docs), before, 0)[:-4]
    return b"".join((head, struct.pack("<I", zlib.crc32(head + table + each)), table, each, *(w.tobytes() for w in words)))


@dataclass
class Segment:
    """What a record says of itself, checked: documents, blocks and where the blocks' words lie."""

    ids: int
    steps: int
    before: int
    docs: np.ndarray
    lanes: np.ndarray
    words: list[np.ndarray]


def open_segment(record: bytes) -> Segment:
    if len(record) < HEADER.size:
        raise ValueError("not a segment")
    magic, n, lanes, steps, docs, before, crc = HEADER.unpack_from(record)
    end = HEADER.size + docs * DOCUMENT.itemsize + lanes * LANE.itemsize
    if magic != MAGIC or zlib.crc32(record[: HEADER.size - 4] + record[HEADER.size : end]) != crc:
        raise ValueError("a segment's header has another checksum")
    table = np.frombuffer(record, DOCUMENT, docs, HEADER.size)
    each = np.frombuffer(record, LANE, lanes, HEADER.size + table.nbytes)
    upto = end + 2 * np.concatenate(([0], np.cumsum(each["words"], dtype=np.int64)))
    # a record that was cut off lacks its last words
    words = [np.frombuffer(record[a:b][: (b - a) // 2 * 2], "<u2") if b <= len(record) else np.zeros(0, "<u2") for a, b in zip(upto.tolist(), upto[1:].tolist())]
    return Segment(n, steps, before, table, each, words)


def decode_blocks(record: bytes, blocks: list[int] | None = None) -> dict[int, np.ndarray | None]:
    """The ids of blocks of a record (all by default), None for those that were damaged; the others don't suffer."""
    own = open_segment(record)
    wanted = range(len(own.lanes)) if blocks is None else blocks
    good = [k for k in wanted if len(own.words[k]) == own.lanes["words"][k] and zlib.crc32(own.words[k].tobytes()) == own.lanes["words_crc"][k]]
    out: dict[int, np.ndarray | None] = dict.fromkeys(wanted)
    if good:
        for k, ids in zip(good, decode_lanes([own.words[k] for k in good], own.steps).astype("<u4")):
            if zlib.crc32(ids.tobytes()) == own.lanes["ids_crc"][k]:
                out[k] = ids[: own.ids - k * own.steps]
    return out


def decode_segment(record: bytes) -> tuple[list[tuple[int | None, np.ndarray]], int]:
    """The documents of a record and `before`; ValueError if any of it was damaged."""
    own, blocks = open_segment(record), decode_blocks(record)
    if damaged := [k for k, x in blocks.items() if x is None]:
        raise ValueError(f"blocks {damaged} have another checksum")
    ids = np.concatenate([*blocks.values(), np.zeros(0, "<u4")]).astype("<u4")
    parts = np.split(ids, np.cumsum(own.docs["ids"])[:-1]) if len(own.docs) else []
    return [(None if d["null"] else int(d["doc_id"]), x) for d, x in zip(own.docs, parts)], own.before


def _segments(path: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What a record is made of: (part, ids before it, table of documents, ids as unsigned 16-bit integers)."""
        encode, part = encoder(path), TaskContext.get().partitionId()
        end = np.array([END_ID], dtype="<u4")
        held: list = []
        names: list = []
        size = before = 0

        def segment() -> pa.RecordBatch:
            nonlocal held, names, size, before
            ids = np.concatenate(held)
            if int(ids.max()) >= 65536:
                raise ValueError("ids must be below 65536")
            table = np.array([(0 if d is None else d, n, d is None) for d, n in names], dtype=DOCUMENT).tobytes()
            out = [pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.array([table], pa.binary()), pa.array([ids.astype("<u2").tobytes()], pa.binary())]
            before += size
            held, names, size = [], [], 0
            return pa.RecordBatch.from_arrays(out, names=["part", "before", "documents", "ids"])

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            at, data = utf8(batch.column(1))
            for a, b in slices(at):
                for doc_id, ids in zip(doc_ids[a:b], encode(data[at[i] : at[i + 1]].tobytes() for i in range(a, b))):
                    held += ids, end
                    names.append((doc_id, len(ids) + 1))
                    size += len(ids) + 1
                    if size >= SEGMENT:
                        yield segment()
        if held:
            yield segment()

    return rows


def coder(spark: SparkSession, name: str):
    """Encode or Decode of TokenCoder.java as a function of columns."""
    return java_function(spark, Path(__file__).with_name("TokenCoder.java"), f"ampliscope.TokenCoder${name}", BinaryType())


def write(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The files (part, segment) of all documents in ascending doc_id order: parts by range, segments in order."""
    ship(docs.sparkSession)
    by_id = F.col("doc_id").asc_nulls_first()
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    laid = rows.repartitionByRange(by_id, begin_of("text").asc_nulls_first()).sortWithinPartitions(by_id, F.col("text").asc_nulls_first())
    parts = laid.mapInArrow(_segments(path or vocabulary_path()), "part int, before long, documents binary, ids binary")
    record = coder(docs.sparkSession, "Encode")(F.col("before"), F.col("documents"), F.col("ids"))
    return materialize(parts.select("part", record.alias("segment")), "token-files")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, index in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = np.frombuffer(index.as_py(), INDEX)
            doc_id = pa.array(own["doc_id"], pa.int64(), mask=own["null"].astype(bool))
            numbers = [pa.array(own[c].astype(np.int64)) for c in ("start", "ids", "ids_crc")]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), part, np.int32)), doc_id, *numbers], names=["part", "doc_id", "start", "n_tokens", "ids_crc32"])


def read_back(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files."""
    spark = files.sparkSession
    index = files.select("part", coder(spark, "Decode")(F.col("segment")).alias("index"))
    found = materialize(index.mapInArrow(_rows, "part int, doc_id long, start long, n_tokens long, ids_crc32 long"), "token-index")
    # a row for each part of the files, as many as the shuffle has partitions
    bases, base = [], 0
    for r in found.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect():
        bases.append((r["part"], base))
        base += r["n"]
    bases = spark.createDataFrame(bases, "part int, base long")
    return found.join(F.broadcast(bases), "part").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    return read_back(write(docs, path))
