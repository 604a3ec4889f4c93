import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kinfold.llm import cotrain, maxent, pagediff

AT = "/root/testdata/sf0.01"


def held(column):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 7 == 2


def test_language_model_counts_and_base(spark):
    rng = random.Random(1)
    words = ["The", "cat", "sat", "on", "mats.", "Überall", "x", "runs", "running", "jumped"]
    texts = [None, "", "\n", *(" ".join(rng.choices(words + [f"rare{i}"], k=rng.randint(1, 40))) for i in range(60)), "never seen before " * 3, "long " * 30000]
    docs = spark.createDataFrame([(i, t, 1.0, "c") for i, t in enumerate(texts)], "doc_id long, text string, score double, token string")
    got = {r.doc_id: r for r in maxent.score(docs, held("doc_id"), common=6, own=4, rounds=2).collect()}
    split = lambda t: [*"".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").split(), ""]
    counts = {}
    for i, t in enumerate(texts):
        if zlib.crc32(str(i).encode()) % 7 != 2:
            for w in split(t):
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for i, t in enumerate(texts):
        found, r = split(t), got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(found), sum(w in counts for w in found), n)
        base = sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in found)
        assert abs(r.base_score - base) <= 1e-9 * abs(base) + 1e-9
        assert r.score < 0
    assert maxent.score(docs.limit(0), held("doc_id")).count() == 0
    untrained = maxent.score(docs.where(held("doc_id")), held("doc_id")).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in untrained)


def plain_mix(step, kind, one, two=None):
    m = 2**64 - 1
    x = (step * 8 + kind) * 0x9E3779B97F4A7C15 + one * 0xC2B2AE3D27D4EB4F & m
    if two is not None:
        x = (x ^ x >> 29) * 0xD6E8FEB86659FD93 + two & m
    return (x ^ x >> 32) * 0xD6E8FEB86659FD93 % 2**64 >> 33


def plain_log(weights, rows, choice):
    scores = [sum(float(weights[r][k]) for r in rows) for k in range(maxent.WIDTH)]
    top = max(scores)
    return scores[choice] - top - math.log(sum(math.exp(x - top) for x in scores))


def plain_features(language, words, i):
    """Rows of both steps for the token at i, by loops."""
    h = lambda k: zlib.crc32(words[k]) + 1 if k >= 0 else 0
    place = language.classes.of(words[i])
    c, buckets, first = place // maxent.WIDTH, len(language.model.weights) - maxent.WIDTH - 1, maxent.WIDTH + 1
    last, before = h(i - 1), h(i - 2)
    tops = [0, first + plain_mix(0, 1, last) % buckets, first + plain_mix(0, 2, before) % buckets, first + plain_mix(0, 3, last, before) % buckets]
    return place, tops, [1 + c, first + plain_mix(1 + c, 1, last) % buckets]


def small_corpus(rng, n=50):
    words = ["der", "die", "katze", "the", "a", "cat", "sat", "runs", "running", "jumped"]
    return [" ".join(rng.choices(words[:3] if i % 2 else words[3:], k=rng.randint(1, 30)) + [f"rare{i % 17}"] * (i % 3 == 0)) for i in range(n)]


def test_language_model_scores_equal_a_plain_loop(spark):
    texts = [*small_corpus(random.Random(31)), "", "never seen before", "The CAT"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    counts = {}
    for t in texts[:50]:
        for w in maxent.tokens(t):
            counts[w] = counts.get(w, 0) + 1
    for common, own in ((3, 5), (1 << 16, 992), (1 << 16, 4)):
        language = maxent.fit(docs.where("doc_id < 50"), common=common, own=own, buckets=64, rounds=3)
        got = {r.doc_id: r.score for r in maxent.score_with(docs, language, F.col("doc_id") >= 50).collect()}
        sizes = {}
        for w, c in counts.items():
            if w not in language.classes.places:
                place = language.classes.of(w)
                sizes[place] = sizes.get(place, 0) + c + 1
        assert sizes == language.sizes
        for i, t in enumerate(texts):
            words, want = maxent.tokens(t), 0.0
            for k, w in enumerate(words):
                place, tops, members = plain_features(language, words, k)
                want += plain_log(language.model.weights, tops, place // maxent.WIDTH) + plain_log(language.model.weights, members, place % maxent.WIDTH)
                if w not in language.classes.places:
                    want += math.log((counts.get(w, 0) + 1) / (sizes.get(place, 0) + 1))
            assert abs(got[i] - want / math.log(10)) < 1e-4 * max(1, abs(want)), (i, got[i], want)


def test_language_model_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(12)
    model = maxent.Model(rng.normal(size=(maxent.WIDTH + 1 + 40, maxent.WIDTH)).astype(np.float64))
    n = 300
    place = rng.integers(0, maxent.WIDTH**2, n)
    before, last = (rng.integers(0, 5, n).astype(np.uint64) for _ in range(2))
    sums, active = np.zeros_like(model.weights), np.zeros(len(model.weights), np.int64)
    value = model.gradient(place, before, last, sums, active)
    assert abs(value - model.score(place, before, last).sum()) < 1e-6 and active[0] == n and active.sum() == 6 * n
    for _ in range(40):
        r, k = rng.integers(len(model.weights)), rng.integers(maxent.WIDTH)
        model.weights[r, k] += 1e-5
        up = model.score(place, before, last).sum()
        model.weights[r, k] -= 1e-5
        assert abs((up - value) / 1e-5 - sums[r, k]) < 1e-2


def test_language_model_member_step_is_worked_out_once_a_history(monkeypatch):
    """By the class and the token before, whose scores are the same wherever they occur; with a table of all pairs and without."""
    rng, seen = np.random.default_rng(13), []
    monkeypatch.setattr(maxent.Model, "totals", lambda self, rows, plain, real=maxent.Model.totals: seen.append(rows.shape[1]) or real(self, rows, plain))
    for buckets in (16, 1 << 16):
        model = maxent.Model(rng.normal(size=(maxent.WIDTH + 1 + buckets, maxent.WIDTH)).astype(np.float64))
        place, before, last = rng.integers(0, 3 * maxent.WIDTH, 4000), *(rng.integers(0, 5, 4000).astype(np.uint64) for _ in range(2))
        seen.clear()
        value = model.gradient(place, before, last, np.zeros_like(model.weights), np.zeros(len(model.weights), np.int64))
        assert sum(seen) <= 15 and abs(value - model.score(place, before, last).sum()) < 1e-6 and sum(seen) <= 30


def test_language_model_is_a_distribution():
    """Over all places, after any history."""
    rng = np.random.default_rng(2)
    model = maxent.Model(rng.normal(size=(maxent.WIDTH + 1 + 16, maxent.WIDTH)).astype(np.float32))
    every = np.arange(maxent.WIDTH**2)
    for before, last in ((0, 0), (0, 7), (9, 7)):
        same = lambda x: np.full(len(every), x, np.uint64)
        assert abs(np.exp(model.score(every, same(before), same(last))).sum() - 1) < 1e-4
    classes = maxent.Classes(["", "a", "b"], ["ng", "ed"])
    last = maxent.WIDTH * (maxent.WIDTH - 1)
    assert [classes.of(w) for w in (b"", b"a", b"b", b"sing", b"led", b"zz")] == [0, 1, 2, last, last + 1, maxent.WIDTH**2 - 1]


def test_language_model_gives_group_tokens_places_too(spark):
    """By default all tokens have one until their group is full; against plain loops, and with the rest a distribution."""
    rng = random.Random(41)
    words = [f"w{i}{end}" for i in range(700) for end in ("ed", "ng", "x", "ü")]
    texts = [" ".join(rng.choices(words, [1 / (i + 3) for i in range(len(words))], k=60)) for _ in range(150)] + ["never seen w1ed words", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    fitted, width = docs.where("doc_id < 150"), maxent.WIDTH
    language = maxent.fit(fitted, buckets=256, rounds=2)
    classes, deep, counts = language.classes, language.deep, {r.token.encode(): r.c for r in language.counts.collect()}
    assert len(counts) > 1400 and set(classes.places) | set(classes.within) == set(counts) and not language.sizes
    few = maxent.fit(fitted, own=1200, buckets=256, rounds=2)  # fewer places: a rest in some groups
    assert len(few.classes.places) + len(few.classes.within) == 1200 and sum(few.sizes.values()) == sum(c + 1 for w, c in counts.items() if w not in few.classes.places and w not in few.classes.within)
    for language in (language, few):
        classes, deep = language.classes, language.deep
        got = {r.doc_id: r.score for r in maxent.score_with(docs, language, F.col("doc_id") >= 150).collect()}
        for i in (0, 1, 150, 151):
            split, want = maxent.tokens(texts[i]), 0.0
            for k, w in enumerate(split):
                place, tops, members = plain_features(language, split, k)
                want += plain_log(language.model.weights, tops, place // width) + plain_log(language.model.weights, members, place % width)
                if w not in classes.places:
                    group, at, last = place % width, classes.within.get(w, width * (width - 1)), zlib.crc32(split[k - 1]) + 1 if k else 0
                    want += plain_log(deep.weights, [group, deep.BIASES + plain_mix(group, 4, last) % 256], at // width)
                    if w in classes.within:
                        node = group * width + at // width
                        want += plain_log(deep.weights, [width + node, deep.BIASES + plain_mix(node, 5, last) % 256], at % width)
                    else:
                        want += math.log((counts.get(w, 0) + 1) / (language.sizes.get(place, 0) + 1))
            assert abs(got[i] - want / math.log(10)) < 1e-4 * max(1, abs(want)), (i, got[i], want)
        every = np.array([*range(width * (width - 1)), *(p + width * width * x for p in range(width * (width - 1), width * width) for x in range(width * (width - 1) + 1))])
        last = np.full(len(every), zlib.crc32(b"w0ed") + 1, np.uint64)
        assert abs(np.exp(language.model.score(every % (width * width), last, last) + deep.score(every, last)).sum() - 1) < 1e-4


def test_language_model_encoder_learns_new_words_at_once():
    """Paths by the last letters, which needn't be ASCII or two; the same as word by word, after a reset too."""
    classes = maxent.Classes(["", "a"], ["ed", "üd", "d", "ng"], 2, ["xed", "üd"], 2)
    encoder = maxent.Encoder(classes, {b"a": 9, b"bed": 1})
    words = "a bed led xed üd rüd d ng öd x é ed ring".encode().split()
    for _ in range(2):
        path, before, last, gain, numbers, starts = encoder.encode([[*words, b""], [b"led", b"new", b""]])
        all_words = [*words, b"", b"led", b"new", b""]
        assert path.tolist() == [classes.path(w) for w in all_words] and [encoder.words[i] for i in numbers] == all_words
        assert np.allclose(gain, [1.0 if w == b"a" else math.log10(2) if w == b"bed" else -1 for w in all_words])
        assert last.tolist()[1:3] == [zlib.crc32(w) + 1 for w in words[:2]] and encoder.held == sum(map(len, set(all_words)))
        encoder.reset()
    assert len(encoder.tails) > 3 and all(t.isascii() for t in encoder.tails)


def test_language_model_splits_arrays_as_texts():
    """The words and the end of each text, whatever surrounds them."""
    texts = [None, "", " ", "A", "\t\x0b a  B\r\n", "\x0cÄb\x1cC\x85d\u2003e f\x00G ", "a " * 3000 + "a", "ẞ İ K"]
    for kind in (pa.string(), pa.large_string()):
        lengths, words = maxent.split_tokens(pa.array([None, *texts], kind).slice(1))
        assert words.cast(pa.binary()).to_pylist() == [w for t in texts for w in maxent.tokens(t)]
        assert lengths.dtype == np.int64 and lengths.tolist() == [len(maxent.tokens(t)) for t in texts]
    assert maxent._words(pa.array([b"", b"a", b"\xc3\xa4"])) == [b"", b"a", b"\xc3\xa4"] and maxent._words(pa.array([b""])) == [b""]
    tokens = [["x", "y", ""], ["x", ""]]
    encoder = maxent.Encoder(maxent.Classes(["", "x"], []))
    lengths, words = maxent.split_tokens(pa.array([" ".join(t) for t in tokens]))
    assert all((a == b).all() for a, b in zip(encoder.encode_words(lengths, words), encoder.encode([[w.encode() for w in t] for t in tokens])))


def test_language_model_counts_come_in_parts(spark):
    """Over a partition's slices, and where a partition has more tokens than it holds."""
    texts = [f"w{i % 7} w{i} W{i + 1}" for i in range(300)] + [None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    want = Counter(w.decode() for t in texts for w in maxent.tokens(t))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        for held in (1 << 20, 200, 10):
            assert {r.token: r.c for r in maxent.count_tokens(docs, held).collect()} == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_language_model_adds_rows_in_any_order_and_blocks():
    rng, n = np.random.default_rng(15), 2 * maxent.CHUNK + 77
    row, x = rng.integers(0, 900, n), rng.integers(-9, 9, (n, maxent.WIDTH)).astype(np.float32)
    row[:5000] = 3  # a run over more than one block
    want, got, sorted_got = (np.zeros((900, maxent.WIDTH), np.float32) for _ in range(3))
    np.add.at(want, row, x)
    order = maxent._order(row, 900)
    maxent._add_runs(row, x, got, order)
    maxent._add_runs(row[order], x[order], sorted_got)
    assert (got == want).all() and (sorted_got == want).all()


def test_language_model_steps_within_groups_need_no_scaling():
    """Unless scores are large; in classes without tokens, whose choices are all alike, too."""
    width = maxent.WIDTH
    shares = np.zeros((width, width * width))
    shares[:, width * (width - 1)] = 1
    shares[3, :40] = 1
    deep = maxent.Deep.new(40, shares / shares.sum(1, keepdims=True))
    assert deep.plain()
    assert abs(np.exp(deep.score(np.array([3 + width * (width - 1) + width * width * x for x in range(width * (width - 1) + 1)]), np.ones(width * (width - 1) + 1, np.uint64))).sum() - 1) < 1e-4
    path = np.array([3 + width * (width - 1) + width * width * x for x in (0, 39, width * (width - 1))])
    plain = deep.score(path, np.arange(3, dtype=np.uint64))
    assert np.allclose(plain, [math.log(1 / 41)] * 3, atol=1e-4)
    deep.weights[maxent.Deep.BIASES :] = 70  # alike for all choices: the same probabilities
    assert not deep.plain() and np.allclose(deep.score(path, np.arange(3, dtype=np.uint64)), plain, atol=1e-4)


def test_language_model_gradient_within_groups():
    rng, width, n = np.random.default_rng(14), maxent.WIDTH, 400
    deep = maxent.Deep(rng.normal(size=(maxent.Deep.BIASES + 40, width)))
    path = rng.integers(width * (width - 3), width * width, n)
    path += width * width * np.where(path >= width * (width - 1), rng.integers(0, width * (width - 1) + 1, n), 0)
    last = rng.integers(0, 5, n).astype(np.uint64)
    sums, active = np.zeros_like(deep.weights), np.zeros(len(deep.weights), np.int64)
    value = deep.gradient(path, last, sums, active)
    assert abs(value - deep.score(path, last).sum()) < 1e-6
    for r in [*rng.choice(np.flatnonzero(active), 30), *rng.integers(0, len(active), 5)]:
        k = rng.integers(width)
        deep.weights[r, k] += 1e-5
        up = deep.score(path, last).sum()
        deep.weights[r, k] -= 1e-5
        assert abs((up - value) / 1e-5 - sums[r, k]) < 1e-2


def test_language_model_rounds_raise_likelihood(spark):
    docs = spark.createDataFrame(list(enumerate(small_corpus(random.Random(3), 400))), "doc_id long, text string").repartition(2)
    few, more = (maxent.fit(docs, rounds=r, buckets=1 << 10) for r in (1, 8))
    # each round's likelihood is of documents that it hasn't learnt from
    assert more.likelihood[-1] > more.likelihood[0] + 0.3 and abs(few.likelihood[0] - more.likelihood[0]) < 0.2


def test_language_model_of_repeated_rows_and_ties(spark):
    rows = [(1, "a b a"), (1, "a b a"), (1, "other words"), (None, "a b"), (None, "a b"), (None, None), (2, "c d e f")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, row string")
    got = maxent.score(docs, held("doc_id"), common=2, own=3, rounds=1).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 1), (0, 3), (0, 3), (1, 3), (1, 4), (1, 4), (2, 5)]
    assert all(r.held_out for r in got if r.doc_id is None) and len({r.train_tokens for r in got}) == 1
    tied = spark.createDataFrame([(1, " ".join(f"t{i:02d}" for i in range(40)))], "doc_id long, text string")
    language = maxent.fit(tied, common=10, own=8, rounds=1)  # all counts alike: the smaller tokens are the common ones
    assert sorted(language.top) == [b"", *(b"t%02d" % i for i in range(9))]
    assert language.classes.own == ["", *(f"t{i:02d}" for i in range(7))]


def test_language_model_beats_base_on_held_out(spark):
    from kinfold.llm import queries

    rows = queries.op10_language_model(spark, AT).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


def test_quality_on_held_out_labels(spark):
    at = "/root/testdata/sf0.1"  # smaller tables have too few labels of low quality
    docs, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
    learnt, kept = labels.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 = 0")
    found = cotrain.score(docs, cotrain.fit(docs, learnt)).select("doc.doc_id", "keep", "quality_score", "toxic_score").join(kept, "doc_id").collect()
    assert len(found) > 1000
    assert sum((r.quality_score >= 0.5) == bool(r.quality) for r in found) / len(found) > 0.97
    toxic, clean = [r for r in found if r.toxic], [r for r in found if r.quality and not r.toxic]
    print("toxic rejected", sum(not r.keep for r in toxic) / len(toxic), "clean kept", sum(r.keep for r in clean) / len(clean))
    assert sum(not r.keep for r in toxic) / len(toxic) > 0.9
    assert sum(r.keep for r in clean) / len(clean) > 0.98


def test_quality_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, keep string, doc string"
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(["good", "words", "of", "prose"], k=20)) if i % 2 else "spam " * 20, None if i % 5 == 0 else "en", None, None, "k", "d") for i in range(60)]
    rows += [(100, None, None, None, None, None, None), (101, "", "xx", "new", -3, "", ""), (102, "a " * 50000, "en", "s", 1, "", ""), (None, "good words", "en", "s", 1, "", ""), (None, None, None, None, None, None, None)]
    rows += [(3, rows[3][1], None, None, None, "k", "d")] * 3 + [(5, "spam", None, None, None, "k", "d")]  # ids that repeat
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (41, None, 0)], "doc_id long, quality int, toxic int")
    models = cotrain.fit(docs, labels)
    assert set(models) == {"quality"}  # no text is labelled toxic
    found = cotrain.score(docs, models)
    assert found.count() == len(rows) and found.select("doc.*").columns == docs.columns
    assert found.where("toxic_score is not null").count() == 0
    keep = {r.doc_id: r.keep for r in found.select("doc.doc_id", "keep").collect()}
    assert all(keep[i] == bool(i % 2) for i in range(40, 60))
    assert cotrain.fit(docs, labels.limit(0)) == {} and cotrain.fit(docs, labels.where("quality = 1")) == {}
    assert cotrain.fit(docs.limit(0), labels) == {}
    assert cotrain.score(docs, {}).where("keep").count() == len(rows)
    assert cotrain.score(docs.limit(0), {}).count() == 0


def plain_places(text):
    """place: value, by a loop."""
    counts = {}
    for word in (text or "").encode().split():
        word = word.lower().strip(cotrain.MARKS).decode()
        for part in [word] + ["^" + word[:5]] * (len(word) > 5):
            place = zlib.crc32(part.encode()) % cotrain.PLACES
            counts[place] = counts.get(place, 0) + 1
    return {p: min(255, round(math.log(1 + n) * cotrain.STEPS)) / cotrain.STEPS for p, n in counts.items()}


def plain_text_odds(model, text):
    measures = cotrain.text_row(text, cotrain.Words())[0].astype("f4").astype(float)
    k = cotrain.MEASURES + 1
    odds = sum((m - a) / b * w for m, a, b, w in zip(measures, model.mean, model.scale, model.weights)) + model.weights[k - 1]
    return max(-30.0, min(30.0, odds + sum(v * model.weights[k + p] for p, v in plain_places(text).items())))


def test_rounds_equal_a_plain_loop(spark):
    rng = random.Random(14)
    good, bad = [f"fine{i}" for i in range(40)], [f"spam{i}" for i in range(40)]
    rows = []
    for i in range(260):
        kind = i % 3 == 0
        words = rng.choices(bad if kind else good, k=rng.randint(3, 25)) + rng.choices(good + bad, k=rng.randint(0, 6))
        rows.append((i, " ".join(words), rng.choice(["en", "de"]), f"src{rng.randint(0, 2) + 2 * kind}", 5 * len(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(120)], "doc_id long, quality int")
    at = {r.doc_id: (r.h, r.doc_id) for r in docs.select("doc_id", F.xxhash64("doc_id", F.lit(7)).alias("h")).collect()}
    got = cotrain.fit(docs, labels, rounds=2, share=0.1, sure=0.7)["quality"]
    # the same by a loop over plain rows
    memo = cotrain.Words()
    view = {i: (cotrain.text_row(t, memo), cotrain.meta_view(lang, source, n).astype("f4").astype(float)) for i, t, lang, source, n in rows}
    texts = lambda ids: cotrain.Texts.of([(view[i][0][0].astype("f4").astype(float), view[i][0][1], view[i][0][2] / cotrain.STEPS) for i in ids])
    metas = lambda ids: np.array([view[i][1] for i in ids]).reshape(len(ids), cotrain.META)
    order = sorted(range(120), key=at.get)
    y = {i: float(i % 3 != 0) for i in range(120)}
    learnt, held = [i for k, i in enumerate(order) if k % 5], [i for k, i in enumerate(order) if k % 5 == 0]
    given = [{}, {}]
    n_good = sum(y.values())
    quota = [max(1, round(0.1 * 120 * (120 - n_good) / 120)), max(1, round(0.1 * 120 * n_good / 120))]

    def fitted():
        ids = [learnt + list(g) for g in given]
        ys = [np.array([y[i] for i in learnt] + list(g.values())) for g in given]
        models = cotrain.TextLogistic.fit(texts(ids[0]), ys[0]), cotrain.Logistic.fit(metas(ids[1]), ys[1])
        target = np.array([y[i] for i in held])
        return models, [cotrain.calibration(models[0].odds(texts(held)), target), cotrain.calibration(models[1].odds(metas(held)), target)]

    for _ in range(2):
        models, scales = fitted()
        news = [{}, {}]
        for v in (0, 1):
            p = {}
            for i in range(120, 260):
                odds = plain_text_odds(models[0], rows[i][1]) if v == 0 else float(models[1].odds(metas([i]))[0])
                p[i] = 1 / (1 + math.exp(-(odds * scales[v][0] + scales[v][1])))
            for label in (0, 1):
                certainty = {i: round(x if label else 1 - x, 6) for i, x in p.items() if (x if label else 1 - x) >= 0.7 and i not in given[1 - v]}
                ranks = sorted(certainty, key=lambda i: -certainty[i])
                if len(ranks) > quota[label]:  # a tie at the quota would leave the choice to row numbers
                    assert certainty[ranks[quota[label] - 1]] > certainty[ranks[quota[label]]]
                news[1 - v] |= {i: float(label) for i in ranks[: quota[label]]}
        for v in (0, 1):
            given[v] |= news[v]
    assert given[0] and given[1]
    models, scales = fitted()
    assert np.allclose(scales, [got.text_scale, got.meta_scale], rtol=1e-3, atol=1e-3)
    scored = {r.doc_id: r for r in cotrain.score(docs, {"quality": got}).select("doc.doc_id", "text_score", "meta_score").collect()}
    for i in range(260):
        text = plain_text_odds(models[0], rows[i][1]) * scales[0][0] + scales[0][1]
        assert abs(scored[i].text_score - 1 / (1 + math.exp(-text))) < 2e-3
        meta = float(models[1].odds(metas([i]))[0]) * scales[1][0] + scales[1][1]
        assert abs(scored[i].meta_score - 1 / (1 + math.exp(-meta))) < 2e-3


def test_co_training_hands_labels_to_the_other_view():
    rng = np.random.default_rng(5)
    y = np.array([0, 1] * 10, float)
    truth = (rng.random(600) < 0.5).astype(float)

    def see(t, noise):
        x = np.zeros((len(t), cotrain.MEASURES))
        x[:, 0], x[:, 1:5] = t + rng.normal(0, noise, len(t)), rng.normal(size=(len(t), 4))
        return x

    words = lambda x: cotrain.Texts(x, np.empty(0, int), np.empty(0, int), np.empty(0))
    meta = lambda x: np.column_stack((x, np.zeros((len(x), cotrain.META - cotrain.MEASURES))))
    training = cotrain.CoTraining(cotrain.split(words(see(y, 0.2)), meta(see(y, 0.6))), y)
    fresh = (rng.random(4000) < 0.5).astype(float)
    x = meta(see(fresh, 0.6))
    right = lambda: ((training.models[1].odds(x) > 0) == fresh).mean()
    alone = right()
    pool_text, pool_meta = words(see(truth, 0.2)), meta(see(truth, 0.6))
    p = training.judge().sure(pool_text, pool_meta)[0]
    some = np.flatnonzero((p > 0.7) | (p < 0.3))
    training.give(1, pool_text.take(some), pool_meta[some], (p[some] > 0.5).astype(float))
    training.fit()
    assert right() > alone


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><a>Home</a></nav>
<!-- x --><div class="ad">Buy</div><article><header><h1>Title &amp; more</h1></header><p>First  <b>bold</b>
line.<br><p>Second &lt;tag&gt; 3 < 4 &nbsp;x<script>var t="</p>";</script><div id="comments"><p>me too</p></div><aside>see</aside></article>
<form><input><p>mail</p></form><footer>&copy; me</footer></body></html>"""


def test_read_lines():
    text = [line for line, kind in pagediff.read_lines(PAGE) if kind == pagediff.CONTENT]
    assert text == ["Title & more", "First bold line.", "Second <tag> 3 < 4 x"]
    assert pagediff.read_lines(None) == [] and pagediff.read_lines("<p") == [("<p", pagediff.OPEN)]
    assert [x for x, _ in pagediff.read_lines("<script>never ends <p>x")] == []


def brute_lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_shared_lines():
    rng = random.Random(6)
    for _ in range(200):
        a, b = (rng.choices("abcde", k=rng.randint(0, 12)) for _ in range(2))
        places = sorted(pagediff.shared_lines(a, b))
        assert len(places) == brute_lcs(a, b)
        rest = iter(b)
        assert all(any(x == y for y in rest) for x in (a[i] for i in places))


def test_extract_by_differencing(spark):
    plain = "<body><div>Site name</div><p>{}</p><p>{}</p><div>All rights</div></body>"
    pages = [(i, f"http://a.example/x/{i}", plain.format(f"text {i}", f"more {i}")) for i in range(12)]
    pages += [(20, "http://b.example/x", plain.format("alone", "only")), (21, "http://c.example/1", PAGE), (22, None, None), (23, "http://a.example/x/3copy", plain.format("text 3", "more 3")), (24, "http://[bad", "<p>odd</p>"), (25, "http://d.example/", "")]
    df = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, html string, text string, lines string")
    got = {r.page_id: r for r in pagediff.extract(df).collect()}
    assert len(got) == len(pages)
    for i in range(12):
        assert got[i].text == f"text {i}\nmore {i}"
    assert got[23].text == "text 3\nmore 3"
    assert got[20].text == "Site name\nalone\nonly\nAll rights"
    assert got[21].text == "Title & more\nFirst bold line.\nSecond <tag> 3 < 4 x" and got[21].n_chars == len(got[21].text)
    assert got[22].text == "" and got[25].text == "" and got[24].text == "odd"
    assert pagediff.extract(df.limit(0)).count() == 0
