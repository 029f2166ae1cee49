"""Near copies that blocks or distances miss: crowds on a template, and texts of few shingles."""

import random

from ampliscope.llm import near_copies
from tests.llm.test_methods import roots


def brute(texts):
    sets = [set(near_copies._features(t.encode(), 5).tolist()) for t in texts]
    close = [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    return roots(close, range(len(sets)))


def components(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return {r.doc_id: r.component_id for r in near_copies.components(docs).collect()}


def missed(got, want):
    """Components that are too many, and whether any text is joined with one that it isn't with."""
    return len(set(got.values())) - len(set(want.values()))


def test_near_copies_in_a_crowd_on_a_template(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    template = [word() for _ in range(178)]
    texts = []
    for k in range(600):
        own = [*template, *(word() for _ in range(22))]
        texts.append(" ".join(own))
        if k % 3 == 0:
            # only just as similar as 0.8: 21 of 196 shingles are others
            for at in rng.sample(range(5, 170, 5), 4):
                own[at] = word()
            texts.append(" ".join([word(), *own[1:]]))
    want = brute(texts)
    assert len(set(want.values())) == 600
    got = components(spark, texts)
    assert missed(got, want) == 0 and got == want


def test_near_copies_of_four_and_five_shingles(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    texts = []
    for _ in range(60):
        base = [word() for _ in range(8)]
        texts += [" ".join(base), " ".join([*base, word()])]
    want = brute(texts)
    assert len(set(want.values())) == 60
    got = components(spark, texts)
    assert missed(got, want) == 0 and got == want


def test_long_texts_with_a_passage_in_common_are_told_apart_without_their_shingles(spark, monkeypatch):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    texts = []
    for k in range(24):
        own = [word() for _ in range(2500)]
        # of two texts each: not so common that it is ordered last
        passage = passage if k % 2 else [word() for _ in range(300)]
        texts.append(" ".join([*own[: 100 * k], *passage, *own[100 * k :]]))
    # the first again with words apart replaced: similar, but only just
    near = texts[0].split()
    for at in range(10, 2700, 50):
        near[at] = word()
    texts.append(" ".join(near))
    compared, rows = [], {}
    similar, table = near_copies._similar, near_copies.materialize
    monkeypatch.setattr(near_copies, "_similar", lambda docs, pairs, *a: (compared.append(pairs.count()), similar(docs, pairs, *a))[1])
    monkeypatch.setattr(near_copies, "materialize", lambda df, tag: (made := table(df, tag), rows.update({tag: made.count()}))[0])
    want = brute(texts)
    assert len(set(want.values())) == 24
    assert components(spark, texts) == want
    assert sum(compared) <= 2
    # a row for each text and list of texts, not for each shingle of the passage
    assert rows["candidates"] < 25 * 4


def test_a_bitmap_is_the_difference_of_the_halves_of_a_wider_one():
    rng = random.Random(6)
    for n in (0, 1, 700, 3000):
        h = near_copies.np.array([rng.getrandbits(64) for _ in range(n)], near_copies.np.uint64)
        wide = near_copies._wide_flags(h)
        assert 64 * len(wide) >= max(near_copies.FLAGS, 2 * n)
        while len(wide) * 64 > near_copies.FLAGS:
            wide = wide[: len(wide) // 2] ^ wide[len(wide) // 2 :]
        assert (wide == near_copies._flags(h)).all()
