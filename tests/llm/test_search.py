import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from kinfold.llm import components, fingerprint, simhash, topk

AT = "/root/testdata/sf0.001"


def union_find(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(200, x) for x in range(201, 240)] + [(7, 7)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = union_find(240, links)
    touched = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: want[x] for x in touched}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_few_links_cost_two_tables_and_more_take_stars(spark, monkeypatch):
    """A round of stars has some ten stages of all shuffle partitions: the driver's memory and event log are theirs."""
    rng, made = random.Random(5), []
    monkeypatch.setattr(components, "stored", lambda df, real=components.stored: made.append(df) or real(df))
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(b, a) for a, b in zip(range(300, 360), range(301, 361))] + [(5, 5), (None, 3)]
    df = spark.createDataFrame([*links, *links[:50]], "a int, b int")
    few = components.components(df)
    assert len(made) == 2 and few.schema.simpleString() == "struct<node:int,component:int>"
    many = components.components(df, alone=20)
    assert len(made) > 4
    want = union_find(361, [x for x in links if None not in x])
    touched = {x for a, b in links if None not in (a, b) and a != b for x in (a, b)}
    for found in (few, many):
        assert sorted(map(tuple, found.collect())) == sorted((x, want[x]) for x in touched)


def brute_fingerprint(text, width):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_texts(rng):
    words = [f"w{i}é" for i in range(400)]
    texts = []
    for _ in range(25):
        base = rng.choices(words, k=rng.randint(1, 260))
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    return texts


def test_simhash_near_duplicates(spark):
    rng = random.Random(5)
    texts = [*near_texts(rng), None, "", " \n", "one", "One", "two words", "TAB\tsep\x0bwords here", "x " * 9000]
    docs = spark.createDataFrame([(10 * i, t, 1, "c") for i, t in enumerate(texts)], "doc_id long, text string, fingerprint int, component_id string")
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    fps = [brute_fingerprint(t, 3) for t in texts]
    want = union_find(len(texts), [(i, j) for i in range(len(texts)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    for i in range(len(texts)):
        assert got[10 * i].fingerprint % (1 << 64) == fps[i]
        assert got[10 * i].component_id == 10 * want[i]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_simhash_repeated_rows_and_null_ids(spark):
    rows = [(5, "one two three four"), (5, "one two three four"), (5, "something else entirely"), (None, "one two three four"), (3, "ONE two three four"), (None, "only here without id"), (None, None), (9, "")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, node int")
    got = sorted((r.doc_id or 0, r.fingerprint % (1 << 64), r.component_id or 0) for r in simhash.near_duplicates(docs).collect())
    f = lambda t: brute_fingerprint(t, 3)
    a, b, c = f(rows[0][1]), f(rows[2][1]), f(rows[5][1])
    assert got == sorted([(5, a, 3), (5, a, 3), (5, b, 5), (0, a, 3), (3, a, 3), (0, c, 0), (0, 0, 9), (9, 0, 9)])


@pytest.mark.parametrize("most", [60, 1024])
def test_large_buckets_lose_no_link(spark, most):
    """Fingerprints that all share most of their bits: buckets of any size are cut into smaller ones."""
    rng = random.Random(most)
    base, fps = rng.getrandbits(64), set()
    for _ in range(260):
        x = base
        for bit in rng.sample(range(24), rng.randint(0, 9)):
            x ^= 1 << (2 * bit + 9)
        fps.add(x)
    fps = sorted(fps)
    nodes = spark.createDataFrame([(f - (f >> 63 << 64),) for f in fps], "fingerprint long")
    found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(nodes, 3, 8, most).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    place = {f: i for i, f in enumerate(fps)}
    want = union_find(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    assert union_find(len(fps), [(place[a], place[b]) for a, b in found]) == want


def shingle_sets(texts, width=5):
    out = []
    for t in texts:
        words = (t or "").lower().split()
        out.append({" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())
    return out


def similar(a, b, least=0.8):
    return len(a & b) >= least * len(a | b)


@pytest.mark.parametrize("block", [2, 4096])
def test_similar_documents_equal_brute_force(spark, block):
    """A group in which everything lies in the same buckets, and its neighbours by fingerprint don't join it all."""
    rng = random.Random(21)
    words = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(12):
        base = rng.choices(words, k=90)
        for edits in (0, 1, 2, 3, 4, 5, 8):
            copy = list(base)
            for at in rng.sample(range(5, 85), edits):
                copy[at] = rng.choice(words)
            texts.append(" ".join(copy))
    base = [f"v{i}" for i in range(80)]
    for i in range(40):  # the same words in other orders: equal fingerprints, other shingles
        order = list(base)
        rng.shuffle(order)
        texts += [" ".join(order), " ".join([*order[:40], f"x{i}", *order[40:]])]
    texts += [None, "", " ", "one", "One", "one two"]
    docs = spark.createDataFrame([(7 * i, t, 3, "z") for i, t in enumerate(texts)], "doc_id long, text string, node int, component_id string").repartition(3)
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(docs, seeds=8, block=block).collect()}
    sets = shingle_sets(texts)
    want = union_find(len(texts), [(i, j) for i in range(len(texts)) for j in range(i) if similar(sets[i], sets[j])])
    assert got == {7 * i: 7 * w for i, w in enumerate(want)}
    assert simhash.similar_documents(docs.limit(0)).count() == 0


def test_first_of_each_goes_by_row(spark):
    rows = [(5, "a b c d e f", "x"), (5, "something else", "y"), (1, "a b c d e f", "z"), (1, "a b c d e f", "z2"), (None, "a b c d e f", "n"), (None, "alone without id", "m"), (None, "alone without id", "m"), (8, None, "p"), (7, "", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, doc string")
    left = [tuple(r) for r in simhash.first_of_each(docs).collect()]
    assert sorted((i or 0, t) for i, t, _ in left) == [(0, "alone without id"), (1, "a b c d e f"), (5, "something else"), (7, "")]
    assert simhash.first_of_each(docs.limit(0)).columns == docs.columns and simhash.first_of_each(docs.limit(0)).count() == 0


@pytest.mark.parametrize("segments", [4, 8, 16])
def test_pigeonring_loses_no_link(spark, segments):
    rng = random.Random(segments)
    fps = [rng.getrandbits(64) for _ in range(20)] + [0]
    for _ in range(150):
        x = rng.choice(fps)
        for _ in range(rng.randint(1, 5)):
            x ^= 1 << rng.randrange(64)
        fps.append(x)
    fps = sorted(set(fps))
    place = {f: i for i, f in enumerate(fps)}
    nodes = spark.createDataFrame([(f - (f >> 63 << 64),) for f in fps], "fingerprint long")
    found = [(place[r.a % (1 << 64)], place[r.b % (1 << 64)]) for r in simhash.links(nodes, 3, segments).collect()]
    assert all((fps[a] ^ fps[b]).bit_count() <= 3 for a, b in found)
    want = union_find(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    assert union_find(len(fps), found) == want


def brute_top_k(vectors, queries, k, scale=1024):
    whole = {i: [int(np.floor(scale * float(x))) for x in v] for i, v in vectors.items() if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)}
    out = set()
    for q in queries & set(whole):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])}
    return out


@pytest.mark.parametrize("block", [16, 8192])
def test_top_k(spark, block):
    rng = np.random.default_rng(6)
    vectors = {i: (rng.normal(size=12) * rng.choice([0.05, 0.3, 2])).astype("f4").tolist() for i in range(300)}
    vectors |= {1000: vectors[3], 1001: vectors[3], 1002: None, 1003: [], 1004: [1.0, None], 1005: [float("nan")] * 12, 1006: [float("inf")] * 12, 1010: [0.0] * 12, 1100: [1.0, 2.0], 1200: [3.0, -1.0]}
    df = spark.createDataFrame([(i, v, i, 7) for i, v in vectors.items()], "vec_id long, embedding array<float>, score int, id int")
    got = topk.top_k(df, F.col("id") % 20 == 0, 10, block=block, query_block=4).collect()
    stored = {r.vec_id: r.embedding for r in df.collect()}
    assert {tuple(r) for r in got} == brute_top_k(stored, {i for i in vectors if i % 20 == 0}, 10)
    assert topk.top_k(df.limit(0), F.col("id") % 20 == 0, 10).count() == 0


def test_top_k_of_repeated_rows_and_null_ids(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [3.0, 0.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (8, [0.5, 0.5]), (None, [9.0, 9.0]), (20, [1.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, row int")
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("id") % 20 == 0, 2, block=1, query_block=1).collect())
    k = 1024 * 1024
    twice = [(0, 1, 7, 3 * k), (0, 2, 7, 3 * k)]
    assert got == sorted([*twice, *twice, *twice])
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(spark.createDataFrame([(0, [1e8, 1e8]), (1, [1e8, 1e8])], "vec_id long, embedding array<double>"), F.col("id") == 0).collect()


def test_top_k_sends_candidates_only_where_they_can_count(spark):
    rng = np.random.default_rng(16)
    vectors = {i: (rng.normal(size=8) * (5 if i < 100 else 0.01)).astype("f4").tolist() for i in range(400)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<float>")
    got = {tuple(r) for r in topk.top_k(df, F.col("id") % 10 == 0, 5, bands=8, block=16, query_block=3).collect()}
    stored = {r.vec_id: r.embedding for r in df.collect()}
    assert got == brute_top_k(stored, {i for i in vectors if i % 10 == 0}, 5)


def brute_halves(text):
    from xxhash import xxh64_intdigest as x

    words = [w for w in (text or "").lower().replace("\n", " ").replace("\t", " ").split(" ") if w]
    votes, total = [0] * 128, 0
    signed = lambda h: h.to_bytes(8, "little")
    for i, w in enumerate(words):
        a = x(w.encode(), 42)
        b = x(words[i + 1].encode(), a) if i + 1 < len(words) else None
        for h, weight in ((a, max(0, min(len(w), 8) - 3)), (b, 2)):
            if h is None:
                continue
            total += weight
            for half in range(2):
                for bit in range(64):
                    votes[64 * half + bit] += weight * (h >> bit & 1)
                h = x(signed(h), 42)
    return [sum(1 << b for b in range(64) if 2 * votes[64 * half + b] > total) for half in range(2)]


def test_document_fingerprints(spark):
    rng = random.Random(8)
    texts = ["", None, "a", "ab", "abc", "The Quick brown\nfox  jumps", *near_texts(rng)[:30], "émile zola naïve " * 40]
    docs = spark.createDataFrame([(3 * i + 2, t, "z", 5) for i, t in enumerate(texts)], "doc_id long, text string, f0 string, n int").repartition(3)
    got = {r.doc_id: r for r in fingerprint.document_fingerprints(docs, F.col("doc_id") % 4 == 0).collect()}
    own = [brute_halves(t) for t in texts]
    for i, text in enumerate(texts):
        text, nxt = text or "", texts[i - 1] or ""
        k = len(text) // 3
        edited = text[: len(text) - k] + nxt[:k]
        r = got[3 * i + 2]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == "".join(f"{h:016x}" for h in own[i])
        e = brute_halves(edited)
        assert r.edited_fingerprint == "".join(f"{h:016x}" for h in e)
        differ = lambda a, b: sum((x ^ y).bit_count() for x, y in zip(a, b))
        assert abs(r.near_edited - (1 - differ(own[i], e) / 128)) < 1e-12
        assert abs(r.near_next - (1 - differ(own[i], own[i - 1]) / 128)) < 1e-12
        near = sum(1 <= differ(own[i], f) <= 3 for f in {tuple(o) for o in own})
        assert r.n_near == (near if (3 * i + 2) % 4 == 0 else None)
    assert fingerprint.document_fingerprints(docs.limit(0), F.col("doc_id") % 4 == 0).count() == 0
    alone = fingerprint.document_fingerprints(docs.where("doc_id = 17"), F.col("doc_id") % 4 == 0).collect()
    assert alone[0].near_next == 1.0


def test_document_fingerprints_of_repeated_rows_and_null_ids(spark):
    rows = [(4, "the same text twice"), (4, "the same text twice"), (4, "the same text twice"), (4, "another text with this id"), (9, "last of them"), (None, "no id at all here"), (None, None), (2, "first of the ids")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, times int")
    hashes = {r.text: r.h for r in docs.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]]), reverse=True)
    want = []
    for (i, t), (_, n) in zip(order, order[1:] + order[:1]):
        t, n = t or "", n or ""
        k = len(t) // 3
        edited = t[: len(t) - k] + n[:k]
        want.append((str(i), len(t), hashlib.sha256(edited.encode()).hexdigest(), "".join(f"{h:016x}" for h in brute_halves(edited))))
    got = fingerprint.document_fingerprints(docs, F.col("doc_id") % 2 == 0).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.edited_fingerprint) for r in got) == sorted(want)
    assert all(r.n_near_docs >= 2 for r in got if r.n_chars == 19) and all(r.n_near is None for r in got if r.doc_id is None)


def test_block_tables_lose_no_pair(spark):
    rng = random.Random(9)
    fps = [(rng.getrandbits(64), rng.getrandbits(64)) for _ in range(10)]
    for _ in range(120):
        x = list(rng.choice(fps))
        for _ in range(rng.randint(1, 4)):
            x[rng.randrange(2)] ^= 1 << rng.randrange(64)
        fps.append(tuple(x))
    fps = sorted(set(fps))
    signed = lambda f: f - (f >> 63 << 64)
    df = spark.createDataFrame([(signed(a), signed(b)) for a, b in fps], "f0 long, f1 long")
    rows = [tuple(r) for r in fingerprint.within_radius(df, df, 3, 6, most=7).collect()]
    got = set(rows)
    assert len(rows) == len(got)
    want = {(signed(a), signed(b), signed(c), signed(d)) for a, b in fps for c, d in fps if 1 <= (a ^ c).bit_count() + (b ^ d).bit_count() <= 3}
    assert got == want


def test_wide_radius_loses_no_pair_and_counts_documents(spark):
    rng = random.Random(10)
    fps = [(rng.getrandbits(64), rng.getrandbits(64)) for _ in range(10)]
    for _ in range(120):
        x = list(rng.choice(fps))
        for bit in rng.sample(range(128), rng.randint(1, 20)):
            x[bit // 64] ^= 1 << bit % 64
        fps.append(tuple(x))
    fps = sorted(set(fps))
    signed = lambda f: f - (f >> 63 << 64)
    df = spark.createDataFrame([(signed(a), signed(b)) for a, b in fps], "f0 long, f1 long")
    rows = [tuple(r) for r in fingerprint.within_radius(df, df, 15, 8, most=5).collect()]
    got = set(rows)
    assert len(rows) == len(got)
    want = {(signed(a), signed(b), signed(c), signed(d)) for a, b in fps for c, d in fps if 1 <= (a ^ c).bit_count() + (b ^ d).bit_count() <= 15}
    assert got == want
    texts = [*near_texts(rng)[:40], *["the same words again"] * 5, None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    own = [brute_halves(t) for t in texts]
    near = lambda i, j: sum((x ^ y).bit_count() for x, y in zip(own[i], own[j])) <= 15
    rows = {r.doc_id: r for r in fingerprint.document_fingerprints(docs, F.col("doc_id") % 2 == 0, 15, 8).collect()}
    for i in range(len(texts)):
        assert rows[i].n_near_docs == (sum(near(i, j) for j in range(len(texts)) if j != i) if i % 2 == 0 else None)


def test_what_is_asked_of_block_tables_is_not_broadcast(spark):
    fps = spark.range(400).select(F.xxhash64("id").alias("f0"), F.xxhash64("id", F.lit(1)).alias("f1"))
    found = fingerprint.within_radius(fps.limit(40), fps, radius=15, blocks=8)
    found.collect()
    # a query of 8 blocks of 16 bits asks for 136 values, which the planner doesn't see
    plan = found._jdf.queryExecution().executedPlan().toString()
    asked = next(line for line in plan.splitlines() if "Join [entry" in line)
    assert "SortMergeJoin" in asked
