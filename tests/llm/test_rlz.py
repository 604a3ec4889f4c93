import hashlib
import random
import re

import pytest

from kinfold.llm import rlz


def brute(rows, window):
    """n_words, n_removed, kept by document."""
    docs = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    first = {}
    for i in sorted(docs):
        for s in range(len(docs[i]) - window + 1):
            first.setdefault(tuple(docs[i][s : s + window]), (i, s))
    out = {}
    for i, words in docs.items():
        gone = set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s : s + window])] != (i, s):
                gone |= set(range(s, s + window))
        kept = [w for k, w in enumerate(words) if k not in gone]
        out[i] = (len(words), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def corpus(rng, n=60):
    words = [f"w{i}" for i in range(50)] + ["é", "the", "the", "of"]
    passages = [rng.choices(words, k=rng.randint(15, 70)) for _ in range(8)]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            kind = rng.random()
            if kind < 0.45:
                p = rng.choice(passages)
                a = rng.randint(0, len(p) // 2)
                parts += p[a : a + rng.randint(10, 70)]
            elif kind < 0.6:
                parts += rng.choices(words, k=rng.randint(1, 4)) * rng.randint(2, 40)
            else:
                parts += rng.choices(words, k=rng.randint(1, 40))
        rows.append(" ".join(parts) if rng.random() < 0.8 else "\n\t ".join(parts) + " ")
    return rows


@pytest.mark.parametrize("seed,window,gram,crowd,most", [(1, 20, 8, 16, 4096), (2, 20, 8, 1, 4096), (3, 6, 3, 16, 3), (4, 5, 1, 3, 4096), (5, 20, 8, 10**9, 10**9)])
def test_deduplicate(spark, seed, window, gram, crowd, most):
    rng = random.Random(seed)
    texts = corpus(rng)
    texts += [None, "", " ", "a b", texts[3], texts[3], texts[5] + " " + texts[5], "same " * 400]
    ids = rng.sample(range(1000), len(texts))
    rows = list(zip(ids, texts))
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, start int, kept string").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7" if seed % 2 else "10000")
    try:
        found = rlz.deduplicate(docs, window, gram, crowd, most)
        got = {r.doc_id: tuple(r)[1:] for r in rlz.digests(found).collect()}
        assert got == brute(rows, window)
        for r in found.collect():
            assert r.n_removed == sum(s.end - s.start for s in r.spans)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_factors_are_greedy_and_checked_at_their_ends():
    block = rlz.Block(4)
    parsed = lambda text: block.factors(text, [hash(tuple(text[i : i + 4])) for i in range(len(text) - 3)])
    assert parsed([1, 2, 3, 4, 5, 6, 7]) == []
    assert parsed([9, 2, 3, 4, 5, 6, 8, 8]) == [(1, 5)]  # the longest match, from its first word
    assert parsed([3, 4, 5, 6, 8, 8, 1, 2, 3, 4, 5]) == [(0, 4), (1, 5), (6, 5)]  # a window across a factor's end is in the text too
    assert parsed([0] * 9) == [(1, 8)]  # the phrase's own front


def test_common_passage_with_other_words_around(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    passage = rng.choices(words, k=40)
    rows = [(i, " ".join([*rng.choices(words, k=25), *passage[rng.randint(0, 9) :], *rng.choices(words, k=25)])) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = brute(rows, 20)
    for crowd, most in ((16, 4096), (2, 4096), (10**6, 20), (10**6, 10**6)):
        assert {r.doc_id: tuple(r)[1:] for r in rlz.digests(rlz.deduplicate(docs, crowd=crowd, most=most)).collect()} == want


def test_one_id_on_many_rows(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(1, f"{passage} a{i} {passage}") for i in range(60)] + [(2, passage)]
    got = rlz.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.doc_id, r.n_removed) for r in got.collect()} == {(1, 40), (2, 40)} and got.count() == 61


def test_odd_tables(spark):
    text = " ".join(map(str, range(60)))
    docs = spark.createDataFrame([(7, text), (7, text), (None, text), (9, text)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_removed) for r in rlz.deduplicate(docs).collect())
    assert got == [(-1, 0), (7, 0), (7, 0), (9, 60)]
    assert rlz.deduplicate(docs.limit(0)).count() == 0


def test_long_words_and_texts(spark):
    long = "x" * (rlz.CHUNK + 50)
    text = " ".join([long, *map(str, range(30))])
    many = " ".join(str(i % 70000) for i in range(300000))
    rows = [(1, text), (2, "z " + text), (3, many), (4, many[1000:])]
    got = {r.doc_id: tuple(r)[1:] for r in rlz.digests(rlz.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert got == brute(rows, 20)
