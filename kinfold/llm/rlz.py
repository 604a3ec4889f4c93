"""Substring deduplication by relative Lempel-Ziv parsing over dealt reference blocks.

Documents are cut into phrases: the runs of windows (`window` consecutive words) that have the same anchor, which
is the least hash among the window's `gram`-word grams. The anchor depends on the window's words alone, so all
occurrences of a window have it, and a window can repeat only where a phrase with its anchor is: the block that
anchors are dealt to is the only one that a phrase must be parsed against.

Phrases are first dealt by their anchors and compared as wholes: one that the block has from an earlier place is a
duplicate throughout. Where an anchor has several phrases (a repeated passage begins or ends inside them), their words
are dealt to the block, which keeps them as its reference text, in the order of their places, with an index of its windows.
Each phrase is parsed greedily against that text: from a place on, the longest match in it is a factor; one that is a
window or longer is a duplicate span. The next place that is looked up is the first window that reaches beyond the factor's end,
so the windows across factors' ends are checked too.

An anchor with very many phrases (`crowd` in one slice of the texts, `most` in its block) has no block of its own: its
phrases' windows are dealt by their own words, folded in each slice first, so no task gets all of them. Either way is exact.

Hashes: phrases are compared by their anchor and a second hash, single windows likewise, 128 bits together; factors are
compared word by word, by 64-bit hashes of the words.

Defined results: words are runs of bytes other than ASCII white space, case and
punctuation unchanged. A null text has no words. A window counts as repeated if
its words start earlier too: in a smaller id, or in the same document further to
the front. Rows that share an id are one document: a window that several of them have at one place is one
occurrence, and what goes in one of them goes at that place in all. Rows with null ids are left as they are, as are texts shorter
than a window. An empty table gives an empty one. Further columns take no part, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, stored, text_slices, worker_kept

U = np.uint64
#: Odd multipliers of the hashes.
MUL_A, MUL_B, MUL_C = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0xD6E8FEB86659FD93)
BASE = 0x5851F42D4C957F2D
INVERSE = U(pow(BASE, -1, 1 << 64))
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
BYTES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
CHUNK = 1 << 20
#: Crowded anchors that a task remembers.
HOT = 1 << 18
KNOWN, CHECK, CROWDED, MARK = 1, 2, 3, 4
#: Comes before all hashes of a key.
FIRST = -(1 << 63)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * MUL_C
    return x ^ (x >> U(29))


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mix(a * MUL_A + b * MUL_B + U(1))


_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of BASE and of its inverse, up to n at least."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK + 4096)
        up, down = np.full(size, U(BASE)), np.full(size, INVERSE)
        up[0] = down[0] = 1
        _powers[:] = [np.cumprod(up), np.cumprod(down)]
    return _powers


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in the bytes, and the number of words before each document (offsets: where documents begin, and the end)."""
    solid = ~WHITE[data]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    end = solid.copy()
    end[:-1] &= ~solid[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begin[inner] = solid[inner]
    end[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes, in chunks of bytes."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            base = starts[at]
            to = max(at + 1, int(np.searchsorted(ends, base + CHUNK, "right")))
            part = data[base : ends[to - 1]]
            up, down = _power_tables(len(part) + 1)
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTES[part] * up[: len(part)])))
            a, b = starts[at:to] - base, ends[at:to] - base
            out[at:to] = _mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64) * MUL_A)
            at = to
    return out


def gram_hashes(words: np.ndarray, n: int, known: dict[int, np.ndarray]) -> np.ndarray:
    """A hash of each n consecutive words; by doubling."""
    if n not in known:
        if n == 1:
            known[1] = words
        else:
            half = 1 << (n - 1).bit_length() - 1
            first, second = gram_hashes(words, half, known), gram_hashes(words, n - half, known)
            m = max(0, len(words) - n + 1)
            with np.errstate(over="ignore"):
                known[n] = _join(first[:m], second[half : half + m])
    return known[n]


def sliding_least(x: np.ndarray, n: int) -> np.ndarray:
    """The least of each n consecutive values; by doubling."""
    width, out = 1, x
    while width * 2 <= n:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    return np.minimum(out[: len(x) - n + 1], out[n - width :]) if len(x) >= n else x[:0]


def windows(data: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """For each window that lies in one document: document, first word there, anchor, hash."""
    starts, ends, before = word_bounds(data, offsets)
    none = np.empty(0, np.int64)
    if len(starts) < window:
        return none, none, none.view(np.uint64), none.view(np.uint64)
    words = word_hashes(data, starts, ends)
    known: dict[int, np.ndarray] = {}
    anchor = sliding_least(gram_hashes(words, gram, known), window - gram + 1)
    whole = gram_hashes(words, window, known)
    counts = np.maximum(0, np.diff(before) - window + 1)
    doc = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = before[:-1][doc] + start
    return doc, start, anchor[at], whole[at]


def phrases(doc: np.ndarray, start: np.ndarray, anchor: np.ndarray, whole: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """Places of the phrases' first windows, their lengths in windows, hashes, and whether a window repeats inside."""
    n = len(doc)
    cut = np.ones(n, bool)
    cut[1:] = (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1])
    since = np.arange(n) - np.maximum.accumulate(np.where(cut, np.arange(n), 0))
    cut |= since % most == 0
    first = np.flatnonzero(cut)
    length = np.diff(np.append(first, n))
    number = np.cumsum(cut) - 1
    repeats = np.zeros(len(first), bool)
    for shift in range(1, min(most, n)):
        same = (whole[shift:] == whole[:-shift]) & (number[shift:] == number[:-shift])
        repeats[number[:-shift][same]] = True
    with np.errstate(over="ignore"):
        value = _join(whole[first], whole[first + length - 1]) + length.astype(np.uint64)
    return first, length, value, repeats


def _buffers(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where its rows begin."""
    texts = batch.column(column).cast(pa.large_string()).fill_null("")
    joined = pa.concat_arrays([texts])
    offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
    data = np.frombuffer(joined.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _earlier(keys: tuple[np.ndarray, ...], doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Rows whose keys another of these rows has from an earlier place."""
    order = np.lexsort((start, doc, *keys[::-1]))
    same = np.ones(len(order), bool)
    for k in keys:
        k = k[order]
        same[1:] &= k[1:] == k[:-1]
    same[:1] = False
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    doc, start = doc[order], start[order]
    out = np.zeros(len(order), bool)
    out[order] = (doc != doc[head]) | (start != start[head])
    return out


def _rows(batch_doc: np.ndarray, *columns) -> pa.RecordBatch:
    names = ["key", "hash", "doc_id", "start", "n", "kind"]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (columns[0], columns[1], batch_doc, *columns[2:])], names=names)


ROW = "key long, hash long, doc_id long, start int, n int, kind int"


def _spread(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(doc.view(np.uint64) * MUL_B + start.astype(np.uint64)).view(np.int64)


def parse(batches: Iterable[pa.RecordBatch], window: int, gram: int, crowd: int) -> Iterator[pa.RecordBatch]:
    """ROW for each phrase: its anchor and hash, n windows from start on; kind KNOWN (and any key) if this slice has it from an earlier place, CROWDED (and any key) if its anchor has more than `crowd` phrases in a slice, else CHECK if it repeats itself inside, or 0. A crowded anchor gives one more row, of kind MARK."""
    worker_kept("phrases", dict)  # frees what the worker keeps for others
    hot = np.empty(0, np.uint64)
    for batch in text_slices(batches):
        data, offsets = _buffers(batch, 1)
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        doc, start, anchor, whole = windows(data, offsets, window, gram)
        if not len(doc):
            continue
        first, length, value, repeats = phrases(doc, start, anchor, whole, window - gram + 1)
        doc, start, anchor = ids[doc[first]].astype(np.int64), start[first], anchor[first]
        known = _earlier((anchor, value), doc, start)
        names, counts = np.unique(anchor[~known], return_counts=True)
        marked = np.setdiff1d(names[counts > crowd], hot)
        hot = np.union1d(hot if len(hot) < HOT else hot[:0], names[counts > crowd])
        crowded = ~known & np.isin(anchor, hot)
        kind = np.where(known, KNOWN, np.where(crowded, CROWDED, np.where(repeats, CHECK, 0))).astype(np.int32)
        key = np.where(known | crowded, _spread(doc, start), anchor.view(np.int64))
        yield _rows(doc, key, value.view(np.int64), start.astype(np.int32), length.astype(np.int32), kind)
        if len(marked):
            zero = np.zeros(len(marked), np.int32)
            yield _rows(zero.astype(np.int64), marked.view(np.int64), np.full(len(marked), FIRST), zero, zero, zero + MARK)


class _Stream:
    """What is open at the end of a sorted batch: the last key and hash, where they were first, what the key's phrases are (0 while it has but one), and that one."""

    def __init__(self):
        self.key = self.hash = self.doc = self.start = None
        self.kind, self.pending = 0, None


def _repeated(open_: _Stream, key: np.ndarray, value: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that aren't the first with their key and hash, and rows whose first has another place; goes on from what is open."""
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (value[1:] != value[:-1])
    new[0] = key[0] != open_.key or value[0] != open_.hash
    head = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
    inside = head >= 0
    head_doc, head_start = np.where(inside, doc[head], open_.doc or 0), np.where(inside, start[head], open_.start or 0)
    open_.key, open_.hash = key[-1], value[-1]
    open_.doc, open_.start = head_doc[-1], head_start[-1]
    return ~new, (doc != head_doc) | (start != head_start)


def look_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """batches: ROW in the order of key, hash, doc_id, start. ROW for the phrases that are known to be repeated and for those that must be checked: of kind CHECK if their key has several, of kind CROWDED if it is crowded."""
    open_ = _Stream()
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        through = (columns[5] == KNOWN) | (columns[5] == CROWDED)
        if through.any():
            key, value, doc, start, n, kind = [c[through] for c in columns]
            yield _rows(doc, np.zeros(len(doc), np.int64), value, start, n, kind)
        key, value, doc, start, n, kind = columns = [c[~through] for c in columns]
        if not len(key):
            continue
        before = open_.key
        again, repeated = _repeated(open_, key, value, doc, start)
        if repeated.any():
            yield _rows(doc[repeated], np.zeros(repeated.sum(), np.int64), value[repeated], start[repeated], n[repeated], np.full(repeated.sum(), KNOWN, np.int32))
        # one row for each phrase that differs, after the one that was left open
        lead = [np.concatenate((p, c[~again])) for p, c in zip(open_.pending or [c[:0] for c in columns], columns)]
        if not len(lead[0]):
            continue  # more of the phrase that was open
        cut = np.concatenate(([True], lead[0][1:] != lead[0][:-1]))
        group = np.cumsum(cut) - 1
        of = np.where((np.bincount(group) > 1) | (np.bincount(group, lead[5] == CHECK) > 0), CHECK, 0)
        of[np.bincount(group, lead[5] == MARK) > 0] = CROWDED
        if lead[0][0] == before:
            of[0] = max(of[0], open_.kind)
        told, last = of[group], lead[0] == key[-1]
        out = (told > 0) & (lead[4] > 0)
        if out.any():
            yield _rows(lead[2][out], lead[0][out], *[c[out] for c in (lead[1], lead[3], lead[4])], told[out].astype(np.int32))
        if last.any():
            open_.kind = int(told[-1])
            open_.pending = [c[last & (told == 0)] for c in lead]


def check_phrases(batches: Iterable[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """batches: doc_id, text, start, n and kind of phrases to check (arrays). CHECKED for each phrase of kind CHECK, with its words, under its anchor; and for each window of the others, under its own hash."""

    def rows(doc, key, value, start, n, kind, words) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (key, value, doc, start.astype(np.int32), n.astype(np.int32), kind.astype(np.int32))] + [words], names=["key", "hash", "doc_id", "start", "n", "kind", "words"])

    for batch in text_slices(batches):
        data, offsets = _buffers(batch, 1)
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        starts, ends, before = word_bounds(data, offsets)
        words = word_hashes(data, starts, ends)
        row = np.repeat(np.arange(len(ids)), np.diff(batch.column(2).offsets.to_numpy()))
        start, n, kind = (batch.column(i).flatten().to_numpy() for i in (2, 3, 4))
        # rows that share an id may have other texts: what reaches beyond a text is none of its phrases
        fits = start + n + window - 1 <= np.diff(before)[row]
        row, start, n, kind = row[fits], start[fits].astype(np.int64), n[fits].astype(np.int64), kind[fits]
        if not len(row):
            continue
        known: dict[int, np.ndarray] = {}
        anchor = sliding_least(gram_hashes(words, gram, known), window - gram + 1)
        whole = gram_hashes(words, window, known)
        at = before[:-1][row] + start
        some = kind == CHECK
        if some.any():
            size = n[some] + window - 1
            ends_ = np.concatenate(([0], np.cumsum(size)))
            flat = words[np.repeat(at[some] - ends_[:-1], size) + np.arange(ends_[-1])]
            binary = pa.Array.from_buffers(pa.binary(), int(some.sum()), [None, pa.py_buffer((ends_ * 8).astype(np.int32)), pa.py_buffer(flat.astype("<u8"))])
            yield rows(ids[row[some]], anchor[at[some]].view(np.int64), np.zeros(some.sum(), np.int64), start[some], n[some], kind[some], binary)
        row, start, n, at = row[~some], start[~some], n[~some], at[~some]
        if len(row):
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            doc, start, at = ids[np.repeat(row, n)], np.repeat(start, n) + step, np.repeat(at, n) + step
            repeated = _earlier((anchor[at], whole[at]), doc, start)
            with np.errstate(over="ignore"):
                key = np.where(repeated, _spread(doc, start), _join(anchor[at], whole[at]).view(np.int64))
            yield rows(doc, key, whole[at].view(np.int64), start, np.ones(len(at)), repeated * KNOWN, pa.nulls(len(at), pa.binary()))


class Block:
    """A block's reference text, as hashes of words, with an index of its windows."""

    def __init__(self, window: int):
        self.window, self.text, self.index = window, [], {}

    def factors(self, words: list[int], hashes: list[int], doc: int = 0, start: int | None = None) -> list[tuple[int, int]]:
        """The phrase's factors of a window or more against the text, and against the phrase's own front: first word, length. What is new of the phrase is indexed; hashes are those of its windows. What the text has from the phrase's own place (doc, start) is the same occurrence."""
        window, text, index = self.window, self.text, self.index
        base, found, i = len(text), [], 0
        start = base if start is None else start
        text += words
        text.append(-1)  # no word: matches end here
        while i < len(hashes):
            at, of, place = index.setdefault(hashes[i], (base + i, doc, start + i))
            if (of, place) == (doc, start + i) or text[at : at + window] != words[i : i + window]:
                i += 1
                continue
            length = window
            while i + length < len(words) and text[at + length] == words[i + length]:
                length += 1
            found.append((i, length))
            i += length - window + 1  # the first window that the factor doesn't hold
        return found


def factorise(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """batches: CHECKED in the order of key, hash, doc_id, start. doc_id, start, n (windows) of what is repeated."""
    open_, block, of = _Stream(), Block(window), None

    def out(doc, start, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(start, pa.int32()), pa.array(n, pa.int32())], names=["doc_id", "start", "n"])

    for batch in slices(batches, 1024):
        key, value, doc, start, n, kind = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
        known = kind == KNOWN
        if known.any():
            yield out(doc[known], start[known], n[known])
        single = kind == 0
        if single.any():
            _, repeated = _repeated(open_, key[single], value[single], doc[single], start[single])
            yield out(doc[single][repeated], start[single][repeated], n[single][repeated])
        phrases_ = np.flatnonzero(kind == CHECK)
        if not len(phrases_):
            continue
        column = batch.column(6).take(pa.array(phrases_))
        flat = np.frombuffer(b"".join(column.to_pylist()), "<u8")
        sizes = n[phrases_] + window - 1
        hashes, words = gram_hashes(flat, window, {}).tolist(), flat.tolist()
        docs, starts, ns, at = [], [], [], 0
        for name, d, s, size in zip(key[phrases_].tolist(), doc[phrases_].tolist(), start[phrases_].tolist(), sizes.tolist()):
            if name != of:
                block, of = Block(window), name
            for i, length in block.factors(words[at : at + size], hashes[at : at + size - window + 1], d, s):
                docs.append(d)
                starts.append(s + i)
                ns.append(length - window + 1)
            at += size
        yield out(docs, starts, ns)


CHECKED = f"{ROW}, words binary"


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions("key", "hash", "doc_id", "start")


def repeated_phrases(here: DataFrame, window: int, gram: int, crowd: int, most: int) -> tuple[DataFrame, DataFrame]:
    """here: doc_id (without nulls), text and further columns. Two tables of doc_id, start, n (windows): phrases that start earlier too, and factors."""
    parsed = here.select("doc_id", "text").mapInArrow(lambda b: parse(b, window, gram, crowd), ROW)
    looked = stored(_sorted(parsed).mapInArrow(look_up, ROW).select("key", "doc_id", "start", "n", "kind"))
    check, crowded = looked.where(F.col("kind") == CHECK), looked.where(F.col("kind") == CROWDED)
    large = check.groupBy("key").agg(F.count("*").alias("of")).where(F.col("of") > most).select("key", F.lit(CROWDED).alias("more"))
    check = check.join(large, "key", "left").select("doc_id", "start", "n", F.coalesce("more", "kind").alias("kind"))
    unsure = check.unionByName(crowded.select("doc_id", "start", "n", "kind")).select("doc_id", F.struct("start", "n", "kind").alias("p"))
    to_check = unsure.groupBy("doc_id").agg(F.collect_set("p").alias("p")).select("doc_id", *[F.col(f"p.{c}").alias(f"{c}s") for c in ("start", "n", "kind")])
    # with all columns, so that this shuffle of the texts is the one that the removal reads again
    texts = here.join(to_check, "doc_id").select("doc_id", "text", "starts", "ns", "kinds", *here.columns[2:])
    factors = _sorted(texts.mapInArrow(lambda b: check_phrases(b, window, gram), CHECKED)).mapInArrow(lambda b: factorise(b, window), "doc_id long, start int, n int")
    return looked.where(F.col("kind") == KNOWN).select("doc_id", "start", "n"), factors


def _covered(n_words: int, starts, ns, window: int) -> np.ndarray:
    edge = np.zeros(n_words + 1, np.int32)
    a = np.asarray(starts, np.int64)
    b = a + np.asarray(ns, np.int64) + window - 1
    ok = b <= n_words
    np.add.at(edge, a[ok], 1)
    np.add.at(edge, b[ok], -1)
    return np.cumsum(edge[:-1]) > 0


def _plain(docs: DataFrame, column: str, name: str, kind: str):
    """The column under that name and type; as it is if it has both, for an alias would keep a shuffle from being read twice."""
    has = column == name and dict(docs.dtypes)[column] == kind
    return docs[column] if has else docs[column].cast(kind).alias(name)


def deduplicate(docs: DataFrame, window: int = 20, gram: int = 8, crowd: int = 16, most: int = 4096, id_column: str = "doc_id", text_column: str = "text", carry: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by a space; where none goes, the text itself, null included), spans (array of start, end in words); with carry, also row, a struct of docs' other columns."""
    if not 0 < gram < window or window - gram + 1 > window:
        raise ValueError("gram must be less than window")
    others = [docs[f"`{c}`"] for c in docs.columns if c not in (id_column, text_column)] if carry else []
    carried = ["row"] * bool(others)
    more = [F.struct(*others).alias("row")] if others else []
    kept = docs.select(_plain(docs, id_column, "doc_id", "bigint"), _plain(docs, text_column, "text", "string"), *more)
    here = kept.where("doc_id is not null")
    phrase, factors = repeated_phrases(here, window, gram, crowd, most)
    spans = phrase.unionByName(factors).groupBy("doc_id").agg(F.collect_set(F.struct("start", "n")).alias("p")).select("doc_id", F.col("p.start").alias("starts"), F.col("p.n").alias("ns"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            n_words, n_removed, texts, out = [], [], [], []
            for text, starts, ns in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                words = (text or "").encode().split()
                n_words.append(len(words))
                if not starts:
                    n_removed.append(0)
                    texts.append(text)
                    out.append([])
                    continue
                gone = _covered(len(words), starts, ns, window)
                n_removed.append(int(gone.sum()))
                texts.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g]).decode())
                edge = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0])))).tolist()
                out.append([{"start": a, "end": b} for a, b in zip(edge[::2], edge[1::2])])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.string()), pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), *batch.columns[4:]], names=["doc_id", "n_words", "n_removed", "kept", "spans", *carried])

    plain = T._parse_datatype_string("doc_id long, n_words long, n_removed long, kept string, spans array<struct<start:int,end:int>>")
    ints = F.lit(None).cast("array<int>")
    aside = kept.where("doc_id is null").select("doc_id", "text", ints.alias("starts"), ints.alias("ns"), *carried)
    return here.join(spans, "doc_id", "left").select("doc_id", "text", "starts", "ns", *carried).unionByName(aside).mapInArrow(cut, T.StructType([*plain, *[kept.schema[c] for c in carried]]))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the words that stay, joined by a space)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "kept"):
            hashes = [hashlib.sha256(b" ".join((t or "").encode().split())).hexdigest() for t in batch.column("kept").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n_words", "n_removed")), pa.array(hashes, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return found.select("doc_id", "n_words", "n_removed", "kept").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")
