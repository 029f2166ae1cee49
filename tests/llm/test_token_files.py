"""The Java coder of token files against the lanes that define their format, and words new to the encoder."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ampliscope.llm import token_coder, tokens


def documents():
    rng = np.random.default_rng(12)
    sizes = ((1,), (5, 1, 20_000, 3), (9000, 0, 30_000), (50_000,), ())
    drawn = (lambda n: np.minimum(rng.zipf(1.2, n), 65535), lambda n: rng.integers(0, 65536, n), lambda n: rng.integers(0, 3, n), lambda n: rng.integers(0, 65536, n) // 9, None)
    return [[(None if i == 2 else i - 1, draw(n).astype("<u4")) for i, n in enumerate(own)] for own, draw in zip(sizes, drawn) if own]


def test_java_writes_and_reads_the_bytes_of_the_lanes(spark):
    segments = documents()
    rows = []
    for docs in segments:
        table = np.array([(0 if d is None else d, len(x), d is None) for d, x in docs], dtype=token_coder.DOCUMENT).tobytes()
        rows.append((2**40, bytearray(table), bytearray(np.concatenate([x for _, x in docs]).astype("<u2").tobytes())))
    given = spark.createDataFrame(rows, "before long, documents binary, ids binary").coalesce(1)
    records = [bytes(r[0]) for r in given.select(token_coder.coder(spark, "Encode")(F.col("before"), F.col("documents"), F.col("ids"))).collect()]
    assert records == [token_coder.encode_segment(docs, 2**40) for docs in segments]
    files = spark.createDataFrame([(0, bytearray(r)) for r in records], "part int, segment binary")
    want = []
    for docs in segments:
        at = 2**40
        for doc_id, ids in docs:
            want.append((doc_id, at, len(ids), token_coder.zlib.crc32(ids.tobytes())))
            at += len(ids)
    assert sorted(map(repr, map(tuple, token_coder.read_back(files).collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize("place", [3, 30, 40, 60, -10])
def test_java_finds_damage(spark, place):
    broken = bytearray(token_coder.encode_segment(documents()[1]))
    broken[place] ^= 8
    files = spark.createDataFrame([(0, broken)], "part int, segment binary")
    with pytest.raises(Exception, match="checksum|not a segment"):
        files.select(F.length(token_coder.coder(spark, "Decode")(F.col("segment")))).collect()


def test_new_words_of_latin_letters():
    """These go to the model without the tokenizer's own splitting."""
    words, rng = tokens.Words(tokens.vocabulary_path()), random.Random(5)
    letters = [chr(c) for c in range(0x260) if chr(c).isalpha()]
    for word in [*letters, *("".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(3000)), "é", "ẹ́", "straße", "ﬁn"]:
        want = np.array(words.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        assert words[word.encode()] == want, word
