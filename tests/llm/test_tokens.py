import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kinfold.llm import bytebpe, packing, tokencount

ODD = ["", " ", "\n\t ", "a", "don't we'll I'D", "tab\tand\x0bvt", "x" * 3000, "naïve café İstanbul ß ﬁ", "🙂🙂 emoji‍", "数字 12３４ ٣", "a\x1cb \x1f c", " 　 wide\u0085next", "   lead  and   trail   ", "<|endoftext|> <|startoftext|>", "é ́x", "\x00nul"]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, ids string, n_tokens int")


def naive_pieces(word, starts, later):
    at, n = 0, 0
    while at < len(word):
        pool = starts if at == 0 else later
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pool), None)
        if end is None:
            return -1
        at, n = end, n + 1
    return n


def test_longest_match_equals_naive_greedy():
    rng = random.Random(3)
    for _ in range(60):
        letters = "abc"
        make = lambda n: {"".join(rng.choices(letters, k=rng.randint(1, 5))) for _ in range(n)}
        starts, later = make(12), make(12)
        automaton = tokencount.LongestMatch(starts, later)
        for _ in range(120):
            word = "".join(rng.choices(letters + "d", weights=[9, 9, 9, 1], k=rng.randint(1, 14)))
            assert automaton.count(word) == naive_pieces(word, starts, later), (word, starts, later)


def ordinary_pieces():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    return {model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}


def test_count_tokens(spark):
    """Against greedy matching of the mark and the word; the mark alone is a piece."""
    pieces = ordinary_pieces()
    texts = [*ODD, None, "unhappiness reconsidered " * 50, "x" * 200_000]
    got = {r.doc_id: r for r in tokencount.count_tokens(frame(spark, texts), P.path("piece_bpe_32k.model")).collect()}
    for i, text in enumerate(texts[:-1]):
        counts = [naive_pieces("▁" + w, pieces, pieces) for w in (text or "").split()]
        assert (got[i].n_words, got[i].n_tokens, got[i].n_unknown) == (len(counts), sum(abs(c) for c in counts), counts.count(-1))
    assert got[len(texts) - 1].n_words == 1 and got[len(texts) - 1].n_tokens > 10_000
    assert tokencount.count_tokens(frame(spark, []), P.path("piece_bpe_32k.model")).count() == 0


@pytest.fixture
def repeated(spark):
    """Rows that repeat, ids that repeat with other texts, and null ids."""
    rows = [(1, "some words here"), (1, "some words here"), (1, "other words"), (None, "some words here"), (None, None), (2, ""), (None, "some words here")]
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, ids string, n_tokens int")


def by_row(rows, *columns):
    return sorted(tuple(str(r[c]) for c in ("doc_id", *columns)) for r in rows)


def test_every_row_gives_a_row(repeated):
    counts = by_row(tokencount.count_tokens(repeated, P.path("piece_bpe_32k.model")).collect(), "n_words")
    assert counts == sorted([("1", "3"), ("1", "3"), ("1", "2"), ("None", "3"), ("None", "0"), ("2", "0"), ("None", "3")])
    trips = bytebpe.round_trip(repeated, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    assert by_row(trips, "decoded_sha256") == sorted((str(r.doc_id), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in repeated.collect())
    packed = packing.pack(repeated, P.path("word_bpe_49k.json"), 2, capacity=16).collect()
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    sizes = [len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in repeated.collect()]
    assert sum(r.length for r in packed) == sum(sizes) and sorted(r.doc_id is None for r in packed if r.start == 0) == [False] * 4 + [True] * 3


def test_words_that_begin_with_the_lone_mark(spark):
    pieces = ordinary_pieces()
    words = ["2024", "ñandú", "ß", "Ça", "可能", "数字", "3rd", "İstanbul", "12３４", "٣", "the", "unhappiness", "a▁b", "▁", "▁▁x"]
    want = [naive_pieces("▁" + w, pieces, pieces) for w in words]
    assert (want[0], want[2], want[4]) == (5, 2, 3) and -1 in want
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = [*words, *(r.text for r in docs.collect())]
    got = {r.doc_id: r for r in tokencount.count_tokens(frame(spark, texts), P.path("piece_bpe_32k.model")).collect()}
    for i, text in enumerate(texts):
        counts = [naive_pieces("▁" + w, pieces, pieces) for w in (text or "").split()]
        assert (got[i].n_tokens, got[i].n_unknown) == (sum(abs(c) for c in counts), counts.count(-1)), text


@pytest.fixture(scope="module")
def tik():
    ranks = bytebpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_spells_the_whole_vocabulary(tik):
    ranks = bytebpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    bpe = bytebpe.ByteBPE(ranks, P.PATTERN)
    words = [w for w in (t.decode("utf-8", "ignore") for t in list(ranks)[::7]) if w]
    for text in [*ODD, *words, *(a + b for a, b in zip(words[::5], words[3::5]))]:
        ids = bpe.encode(text)
        assert ids == tik.encode_ordinary(text), text
        assert bpe.decode(ids) == text.encode()


def test_byte_bpe_spells_its_entries_by_merging():
    """Pre-tokens that are entries go through the model too; only those that no merges reach are looked up."""
    assert bytebpe.ByteBPE(bytebpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), P.PATTERN).unreached == {}
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"xyz": 257}  # nothing merges to xyz
    bpe = bytebpe.ByteBPE(ranks, P.PATTERN)
    assert bpe.unreached == {b"xyz": 257}
    tik = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("xyz", "ab xyz", "xyzxyz abab", "é"):
        assert bpe.encode(text) == tik.encode_ordinary(text)


def test_byte_bpe_documents(spark, tik):
    texts = [*ODD, None, "word " * 20000]
    docs = frame(spark, texts)
    got = {r.doc_id: r for r in bytebpe.round_trip(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()}
    encoded = bytebpe.encode_documents(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    ids = {r.doc_id: r.ids for r in encoded.collect()}
    back = {r.doc_id: bytes(r.decoded) for r in bytebpe.decode_documents(encoded, P.path("byte_bpe_50k.tiktoken")).collect()}
    for i, text in enumerate(texts):
        want = tik.encode_ordinary(text or "")
        assert ids[i] == want and back[i] == (text or "").encode()
        assert got[i].n_tokens == len(want)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_word_tokenizer_equals_whole_texts():
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    words = packing.WordTokenizer(P.path("word_bpe_49k.json"))
    assert words.by_word
    latin = "".join(chr(c) for c in range(1, 0x250))
    texts = [*ODD, latin, " ".join(latin), "The ñandú&&& isn't İ's 3rd %%% é.É!! o'CLOCK we'LL'd²½ªº", "ΣΑΣ σας ﬀ Ǆ ǅ"]
    rng = random.Random(5)
    texts += ["".join(rng.choices(latin + "'" * 20 + " " * 60, k=60)) for _ in range(300)]
    for text in texts:
        assert words.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def check_packing(rows, expected, capacity):
    """expected: ids by document. Each id in one piece; sequences gapless; no padding but at a power of two."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(expected)
    for doc, pieces in by_doc.items():
        ids, at = np.array(expected[doc], "<u4"), 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == capacity or at < capacity and at & (at - 1) == 0


def test_packing(spark):
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    rng = random.Random(1)
    texts = [*ODD, None, "tail words go on " * 4000, *("many words of text " * rng.randint(0, 120) for _ in range(150))]
    expected = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}
    rows = packing.pack(frame(spark, texts), P.path("word_bpe_49k.json"), 2, capacity=512, group=8).collect()
    check_packing(rows, expected, 512)
    assert packing.pack(frame(spark, []), P.path("word_bpe_49k.json"), 2).count() == 0
    assert packing.pack(frame(spark, texts).limit(0), P.path("word_bpe_49k.json"), 2).schema == packing.pack(frame(spark, texts), P.path("word_bpe_49k.json"), 2).schema


def test_balance_is_even():
    rng = random.Random(2)
    pieces, total = [], 0
    while total < 64 * 4096:
        n = min(rng.randint(1, 1200), 64 * 4096 - total)
        pieces.append((n, len(pieces)))
        total += n
    placed = packing.balance(pieces, 64, 4096, 1.0, 1 / 4096)
    used, cost = [0] * 64, [0.0] * 64
    for s, _, _, _, n in placed:
        used[s] += n
        cost[s] += n * n
    assert used == [4096] * 64
    shuffled = [0.0] * 64
    rng.shuffle(pieces)
    s, room = 0, 4096
    for n, _ in pieces:
        while n:
            take = min(n, room)
            shuffled[s] += take * take
            n, room = n - take, room - take
            if not room:
                s, room = s + 1, 4096
    assert np.std(cost) < np.std(shuffled)


def test_queries_cover_all_rows(spark):
    from kinfold.llm import queries

    at = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{at}/documents.parquet").count()
    assert queries.op1_token_counts(spark, at).count() == n
    assert queries.op5_byte_bpe(spark, at).count() == n
    assert queries.op7_packing(spark, at).select(F.countDistinct("doc_id")).first()[0] == n


def test_long_documents_are_balanced_too():
    rng = np.random.default_rng(4)
    rows = [(i, np.arange(n, dtype=np.uint32)) for i, n in enumerate([*rng.integers(5000, 30000, 40), *rng.integers(1, 900, 2000)])]
    cost, used = {}, {}
    for batch in packing.pack_ids(rows, 3, capacity=4096, group=64):
        for n, s in zip(batch.column(2).to_pylist(), batch.column(5).to_pylist()):
            cost[s], used[s] = cost.get(s, 0) + n + n * n / 4096, used.get(s, 0) + n
    full = [cost[s] for s in cost if used[s] == 4096]
    assert max(full) < 1.35 * np.median(full) and sum(used.values()) == sum(len(x) for _, x in rows)
