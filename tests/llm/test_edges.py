"""Every operator on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ampliscope.llm import cover_tree, langid, mixing, near_copies, packing, quality, quartile_digest, simhash, token_coder, toxicity, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside.
CLASH = ["part", "end", "print", "rep", "length", "start", "rank", "copies", "epochs", "key", "bucket", "score", "terms", "y", "component_id", "node", "row", "copy", "held_out", "perplexity", "own", "segment", "salt", "_n", "_gone", "_row", "gone", "row_", "slot", "host", "path", "component", "cell", "distance", "of", "k", "n"]


def words(rng, n, letters):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for i in range(60):
        lang = "en" if i % 2 else "de"
        out.append((i, words(rng, rng.randint(5, 60), "etaoin" if lang == "en" else "chwzüg"), lang, f"src{i % 4}", 0))
    long = words(rng, 30_000, "etaoin")
    out += [(100, None, None, None, None), (101, "", "en", "src1", 0), (102, "   \n\t ", "de", "src2", 5), (103, "1234 !!", "en", "src0", 7), (104, long, "en", "src0", len(long)), (105, "x" * 200_000, None, "src9", 1), (None, "no id here at all", "en", "src1", 17)]
    out += [out[3], out[3], (106, out[3][1], "en", "src3", 0), (107, "ÄÖÜ ß é 你好 \U0001f600", "de", None, 3)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("clash") for c in CLASH})


@pytest.fixture(scope="module")
def labels(spark, rows):
    return spark.createDataFrame([(r[0], 1, int(r[0] % 3 == 0)) for r in rows if r[0] is not None] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def test_language(docs, rows, empty):
    got = langid.identify(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (100, 101, 102, 103))
    assert by[104].lang_pred == "en" and by[105].lang_pred in ("en", "de")
    assert all(0 <= r.score <= 1 for r in got)
    assert [r for r in got if r.doc_id == 3][0] == [r for r in got if r.doc_id == 3][1]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert langid.identify(empty).collect() == []
    kept = langid.accept(docs, langid.fit(docs), 0.3)
    assert kept.columns == docs.columns and not {100, 101, 102, 103} & {r.doc_id for r in kept.select("doc_id").collect()}


def test_language_without_labels(docs):
    got = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in got} == {"und"} and {r.score for r in got} == {0.0}


def test_toxicity(docs, labels, rows, empty, no_labels):
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[100] == by[101] == by[102] == by[103]
    assert toxicity.toxicity(empty, labels).collect() == []
    assert {r.score for r in toxicity.toxicity(docs, no_labels).collect()} == {0.0}


def test_tokens(docs, rows, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(token_coder.vocabulary_path())
    got = token_coder.round_trip(docs).collect()
    want, at = [], 0
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        want.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert token_coder.round_trip(empty).collect() == []


def test_packing(docs, rows, empty):
    got = packing.pack(docs, size=64).collect()
    per = {}
    for r in got:
        per.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in per.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    by = [r for r in got if r.doc_id in (100, 101, 102)]
    assert [(r.piece, r.length) for r in by] == [(0, 1)] * 3
    assert len([r for r in got if r.doc_id == 3 and r.piece == 0]) == 3
    assert packing.pack(empty).collect() == []


def test_near_fingerprints(docs, rows, empty):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[i].fingerprint == "0" * 16 for i in (100, 101, 102)) and by[100].component_id == 100
    assert by[106].component_id == 3 and by[106].fingerprint == by[3].fingerprint
    assert simhash.near_duplicates(empty).collect() == []


def test_near_copies(spark, docs, rows, empty):
    kept = near_copies.one_of_each(docs)
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert kept.columns == docs.columns
    assert ids.count(3) == 1 and 106 not in ids and None in ids
    assert len({100, 101, 102} & set(ids)) == 1
    assert near_copies.one_of_each(empty).collect() == []
    rng = random.Random(1)
    base = words(rng, 300, "abcdefgh").split()
    near = [" ".join([*base[:k], "changed", *base[k + 1 :]]) for k in (50, 150, 250)]
    far = " ".join(base[:150] + words(rng, 150, "abcdefgh").split())
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate([" ".join(base), *near, far])], SCHEMA)
    assert sorted(r.doc_id for r in near_copies.one_of_each(df).collect()) == [0, 4]


def test_digest(docs, rows, empty):
    got = quartile_digest.fingerprints(docs).collect()
    assert len(got) == len(rows)
    ordered = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -1), r[1] or ""))
    want = []
    for r, after in zip(ordered, ordered[1:] + ordered[:1]):
        text, nxt = r[1] or "", after[1] or ""
        k = len(text) // 3
        want.append((r[0] if r[0] is not None else -1, len(text), hashlib.sha256((text[: len(text) - k] + nxt[:k]).encode()).hexdigest(), quartile_digest.digest(text.encode())))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_chars, r.edited_sha256, r.fingerprint) for r in got) == sorted(want)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert quartile_digest.fingerprints(empty).collect() == []


def test_digest_of_one(spark):
    r = quartile_digest.fingerprints(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).first()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()


def test_mixing(docs, rows, empty):
    got = mixing.mix(docs).collect()
    assert all(r.copies > 0 for r in got) and sum(r.copies * r.n_tokens for r in got) > 0
    held = mixing.mixture(docs)
    assert held.columns == docs.columns and held.count() == sum(r.copies for r in got)
    assert {r.lang for r in got} <= {"en", "de", "und"}
    assert mixing.mix(empty).collect() == [] and mixing.mixture(empty).collect() == []


def test_quality(docs, labels, rows, empty, no_labels):
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.n_bytes == 0:
            assert r.perplexity is None and not r.keep
        else:
            assert r.perplexity > 1 and math.isfinite(r.perplexity)
    found, _ = quality.fit(docs, labels)
    kept = quality.accept(docs, found)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.select("doc_id").collect()) == sorted((r.doc_id or -1) for r in got if r.keep)
    assert quality.classify(empty, labels).collect() == []
    assert all(r.keep == (r.n_bytes > 0) for r in quality.classify(docs, no_labels).collect())


def test_urls(spark):
    pages = spark.createDataFrame([(1, None, None), (2, "no scheme", ""), (3, "HTTP://A.EXAMPLE.COM", None), (4, "http://www.example.com/en/?q", "x" * 100_000), (4, "http://www.example.com/en/?q", None), (5, "://", None)], "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("host", "path", "rule", "r", "node", "alias_allow", "tag")})
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages).collect())
    allowed = (4, "www.example.com", "/en/", "www.example.com/en/", "allow")
    assert got == [(1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "a.example.com", "", None, "allow"), allowed, allowed, (5, "", "", None, "allow")]
    assert url_filter.judge(pages.limit(0)).collect() == []


def test_search(spark):
    v = [(0, [0.5, 0.1]), (50, [0.5, 0.1]), (1, [0.5, 0.1]), (2, None), (3, [0.1, None]), (4, [float("nan"), 0.0]), (5, [float("inf"), 0.0]), (6, []), (7, [-0.5, 0.2]), (1, [0.5, 0.1]), (8, [1.0, 1.0, 1.0]), (None, [0.1, 0.1])]
    df = spark.createDataFrame(v, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("v", "b", "g", "query_row", "rank", "score")})
    got = sorted(map(tuple, cover_tree.top_k(df).collect()))
    same = int(np.floor(np.float32(0.5) * 256)) ** 2 + int(np.floor(float(np.float32(0.1)) * 256)) ** 2
    assert [r[:3] for r in got if r[0] == 0] == [(0, 1, 1), (0, 2, 1), (0, 3, 50), (0, 4, 7)] and got[0][3] == same
    assert cover_tree.top_k(df.limit(0)).collect() == []


def test_quality_of_many_languages(docs, labels, monkeypatch):
    monkeypatch.setattr(quality, "LEAST", 5)
    trusted = labels.withColumn("quality", F.lit(1))
    found, _ = quality.fit(docs, trusted, 0.5)
    want, kept = sorted(quality.classify(docs, trusted, 0.5).collect(), key=str), sorted(quality.accept(docs, found).collect(), key=str)
    monkeypatch.setattr(quality, "MOST_LANGS", 1)
    found, _ = quality.fit(docs, trusted, 0.5)
    assert sorted(quality.classify(docs, trusted, 0.5).collect(), key=str) == want
    assert sorted(quality.accept(docs, found).collect(), key=str) == kept
