"""Near-duplicate documents by SimHash and pigeonring candidates.

A document's fingerprint takes 64 votes from the XXH64 values of its word
shingles. Two fingerprints link at `radius` or fewer differing bits. They are cut
into m segments on a ring: if all differences come to radius or fewer, then from
some segment on, every chain of j consecutive segments holds at most
floor(j * radius / m) of them. The first links of that chain must thus be
equal, and of those that follow all but a few; this gives the keys of an equality
join. Its candidates are then held against the whole chain of budgets, and only
those that keep within it get the full Hamming check.

Equal fingerprints are one node before any candidate is sought, and each bucket
yields a spanning forest of its links, not its pairs, so large groups of copies
cost their number. Buckets are read as sorted streams. One of more than `most` fingerprints is dealt anew: the
bits that its key leaves open are cut into radius + 1 pieces, of which two fingerprints that link have one in common,
so each piece gives a smaller bucket, and so on until all are small, or have so few open bits that they are. No link is lost.

similar_documents() takes fingerprints for candidates only: documents link if their shingles' Jaccard similarity is high enough.
There fingerprints are of the text's words, each weighted by the logarithm of its count, for several seeds.

Defined results: a null or empty text has fingerprint zero, and such texts link
with each other. A text of fewer words than a shingle is one shingle. Every row is a document and gives a row: ids may
be equal or null; a component is named by its smallest id that is none of the nulls, and is null without any. An
empty table gives an empty one. Further columns, whatever their names, take no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Memo, slices, stored, worker_kept
from .components import components

SEED = 42
BITS = 64


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 of each shingle of the text's words, A-Z lower-cased, repeats included."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[: 1 - width or None].tolist(), ends[width - 1 :].tolist())], np.uint64)


def votes(hashes: np.ndarray) -> int:
    """The fingerprint: bits that are set in over half of the hashes."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)]
        counts += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def reseeded(hashes: np.ndarray, seed: int) -> np.ndarray:
    """The hashes as another hash function would have them; seed 0 leaves them."""
    if not seed:
        return hashes
    with np.errstate(over="ignore"):
        x = (hashes + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def weighted_votes(hashes: np.ndarray, weights: np.ndarray, seeds: int) -> list[int]:
    """A fingerprint for each seed: bits that are set in over half of the weight."""
    found = []
    for seed in range(seeds):
        counts = np.zeros(BITS, np.int64)
        for at in range(0, len(hashes), 1 << 15):
            part = reseeded(hashes[at : at + (1 << 15)], seed)
            bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += weights[at : at + (1 << 15)] @ bits
        found.append(int(np.packbits(2 * counts > weights.sum(), bitorder="little").view("<u8")[0]))
    return found


def fingerprints(docs: DataFrame, width: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, fingerprint (long)."""
    kept = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            found = np.array([votes(shingle_hashes(text, width)) for text in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fingerprint"])

    return kept.mapInArrow(run, "doc_id long, fingerprint long")


def budgets(radius: int, segments: int) -> list[int]:
    """By length of a chain, from 1: the differences that it may hold."""
    return [(j * radius) // segments for j in range(1, segments + 1)]


def key_choices(radius: int, segments: int) -> list[tuple[int, ...]]:
    """Segments, counted from the chain's start, that a key takes: the run with no budget, and all but one of the run whose budget is one."""
    allowed = budgets(radius, segments)
    exact, one = allowed.count(0), allowed.count(1)
    if not one:
        return [tuple(range(exact))]
    return [(*range(exact), *rest) for rest in combinations(range(exact, exact + one), one - 1)]


def _segment(fingerprint: Column, at: int, width: int) -> Column:
    return F.shiftrightunsigned(fingerprint, at * width).bitwiseAND((1 << width) - 1)


def keys(fingerprint: Column, radius: int, segments: int) -> Column:
    """Array of the fingerprint's keys: table number and the table's segments."""
    width = BITS // segments
    tables = [[(start + s) % segments for s in choice] for start in range(segments) for choice in key_choices(radius, segments)]
    found = []
    for number, table in enumerate(tables):
        value = F.lit(number).cast("long")
        for at in table:
            value = F.shiftleft(value, width).bitwiseOR(_segment(fingerprint, at, width))
        found.append(value)
    return F.array(*found)


def linked(a: np.ndarray, b: np.ndarray, start: np.ndarray, radius: int, segments: int) -> np.ndarray:
    """Whether pairs of fingerprints keep the chain's budgets from their start segment on (a start below 0 has no chain), and then the radius."""
    width = np.uint64(BITS // segments)
    differ = a ^ b
    turn = np.maximum(start, 0).astype(np.uint64) * width
    ring = (differ >> turn) | np.where(turn == 0, np.uint64(0), differ << ((np.uint64(BITS) - turn) % np.uint64(BITS)))
    ok, total = np.ones(np.broadcast(a, b).shape, bool), np.zeros(np.broadcast(a, b).shape, np.uint8)
    for j, allowed in enumerate(budgets(radius, segments)):
        part = (ring >> (np.uint64(j) * width)) & ((np.uint64(1) << width) - np.uint64(1))
        total = total + np.bitwise_count(part)
        ok &= (total <= allowed) | (start < 0)
        if not ok.any():
            return ok
    return ok & (np.bitwise_count(differ) <= radius)


def _forest(fps: np.ndarray, start: int, radius: int, segments: int) -> list[tuple[int, int]]:
    """Places of links that connect all of a bucket's fingerprints that its links connect."""
    label, found = np.arange(len(fps)), []
    begin = np.array(start)
    for i in range(1, len(fps)):
        hits = np.flatnonzero(linked(fps[:i], fps[i], begin, radius, segments))
        if not len(hits):
            continue
        groups, first = np.unique(label[hits], return_index=True)
        found += [(i, int(hits[f])) for f in first]
        label[i] = groups[0]
        for other in groups[1:]:
            label[:i][label[:i] == other] = groups[0]
    return found


def tables(radius: int, segments: int) -> tuple[int, int]:
    """The number of tables, and the bits of a key that come after its table's number."""
    return segments * len(key_choices(radius, segments)), len(key_choices(radius, segments)[0]) * (BITS // segments)


def open_bits(radius: int, segments: int) -> np.ndarray:
    """By table: the bits that its keys leave open."""
    width, out = BITS // segments, []
    for start in range(segments):
        for choice in key_choices(radius, segments):
            taken = {(start + s) % segments for s in choice}
            out.append(sum(((1 << width) - 1) << (s * width) for s in range(segments) if s not in taken))
    return np.array(out, np.uint64)


def smaller_buckets(key: np.ndarray, left: np.ndarray, fp: np.ndarray, pieces: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For rows of a bucket that is too large: (row, key, open bits) of the buckets that each piece of its open bits gives."""
    rows, keys_, open_ = [], [], []
    for mask in np.unique(left).tolist():
        at = np.flatnonzero(left == np.uint64(mask))
        places = [b for b in range(BITS) if mask >> b & 1]
        for piece in range(pieces):
            taken = sum(1 << b for b in places[piece::pieces])
            with np.errstate(over="ignore"):
                x = (fp[at] & np.uint64(taken)) + np.uint64(piece + 1) * np.uint64(0x9E3779B97F4A7C15)
                x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + key[at].view(np.uint64)
                x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
            rows.append(at)
            keys_.append((x ^ (x >> np.uint64(32))).view(np.int64))
            open_.append(np.full(len(at), mask & ~taken, np.uint64))
    return np.concatenate(rows), np.concatenate(keys_), np.concatenate(open_)


#: Open bits that leave a bucket few fingerprints.
FEW = 11
LINKS = "a long, b long, key long, open long, start int"


def bucket_links(batches: Iterable[pa.RecordBatch], radius: int, segments: int, most: int) -> Iterator[pa.RecordBatch]:
    """batches: key, fingerprint, open, start, in the order of their keys, fingerprints distinct in each. LINKS: fingerprints a, b that link and connect a bucket; and rows (a, with key, open and start -1) of the smaller buckets that one of more than `most` falls into. start: the chain's first segment, -1 in smaller buckets."""
    held: list[np.ndarray] = [np.empty(0, np.int64)] * 4
    large = None  # the key of a bucket whose rows are passed on

    def passed(key: np.ndarray, fp: np.ndarray, left: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
        row, key, left = smaller_buckets(key, left.view(np.uint64), fp.view(np.uint64), radius + 1)
        return pa.RecordBatch.from_arrays([pa.array(fp[row]), pa.nulls(len(row), pa.int64()), pa.array(key), pa.array(left.view(np.int64)), pa.array(np.full(len(row), -1, np.int32))], names=["a", "b", "key", "open", "start"])

    def done(key: np.ndarray, fp: np.ndarray, left: np.ndarray, start: np.ndarray) -> Iterator[pa.RecordBatch]:
        edges_at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True]))) if len(key) else np.zeros(1, np.int64)
        length = np.diff(edges_at)
        large_ = (length > most) & (np.bitwise_count(left.view(np.uint64)[edges_at[:-1]]) > FEW)
        over = np.repeat(large_, length)
        if over.any():
            yield passed(*(x[over] for x in (key, fp, left, start)))
        bits = fp.view(np.uint64)
        two = edges_at[:-1][length == 2]
        two = two[linked(bits[two], bits[two + 1], start[two], radius, segments)] if len(two) else two
        a, b = [fp[two]], [fp[two + 1]]
        some = (length > 2) & ~large_
        for at, n in zip(edges_at[:-1][some].tolist(), length[some].tolist()):
            pairs = _forest(bits[at : at + n], int(start[at]), radius, segments)
            if pairs:
                i, j = np.array(pairs).T
                a.append(fp[at + i])
                b.append(fp[at + j])
        a, b = np.concatenate(a), np.concatenate(b)
        none = pa.nulls(len(a), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), none, none, pa.nulls(len(a), pa.int32())], names=["a", "b", "key", "open", "start"])

    for batch in batches:
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if large is not None:
            more = now[0] == large
            if more.any():
                yield passed(*(x[more] for x in now))
            now = [x[~more] for x in now]
        if not len(now[0]):
            continue
        large = None
        now = [np.concatenate((h, x)) for h, x in zip(held, now)]
        cut = int(np.searchsorted(now[0], now[0][-1]))  # the last bucket may go on
        yield from done(*(x[:cut] for x in now))
        held = [x[cut:] for x in now]
        if len(held[0]) > most and int(held[2][0] & (2**63 - 1)).bit_count() + int(held[2][0] < 0) > FEW:
            yield passed(*held)
            large, held = int(held[0][0]), [x[:0] for x in held]
    yield from done(*held)


def links(nodes: DataFrame, radius: int = 3, segments: int = 8, most: int = 1024) -> DataFrame:
    """a, b: links between fingerprints (column fingerprint, distinct) that connect whatever the radius connects."""
    count, value_bits = tables(radius, segments)
    table = F.shiftright("key", value_bits).cast("int")
    masks = F.array(*[F.lit(int(m) - (1 << 64) * (int(m) >> 63)).cast("long") for m in open_bits(radius, segments)])
    rows = nodes.select("fingerprint", F.explode(keys(F.col("fingerprint"), radius, segments)).alias("key"))
    rows = rows.select("key", "fingerprint", F.get(masks, table).alias("open"), F.floor(table / (count // segments)).cast("int").alias("start"))
    found = None
    while True:
        dealt = rows.repartition("key").sortWithinPartitions("key")
        got = stored(dealt.mapInArrow(lambda batches: bucket_links(batches, radius, segments, most), LINKS))
        pairs = got.where("b is not null").select("a", "b")
        found = pairs if found is None else found.unionByName(pairs)
        rows = got.where("key is not null").select("key", F.col("a").alias("fingerprint"), "open", "start")
        if rows.isEmpty():
            return found.distinct()


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 3, segments: int = 8, most: int = 1024, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, fingerprint (long), component_id: the smallest doc_id that links reach."""
    _check(radius, segments)
    found = stored(fingerprints(docs, width, id_column, text_column))
    # documents with one fingerprint are one from here on
    classes = stored(found.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    groups = components(links(classes, radius, segments, most)).withColumnRenamed("node", "fingerprint")
    named = stored(classes.join(groups, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint")))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return found.join(named.join(names, "component").select("fingerprint", "component_id"), "fingerprint").select("doc_id", "fingerprint", "component_id")


def _check(radius: int, segments: int) -> None:
    if radius < 0 or BITS % segments or segments <= radius:
        raise ValueError("segments must divide 64 and be more than radius")


PAIRS = "a long, b long, key long"
#: Places between the neighbours of a bucket that are compared first.
REACH = 2
#: Seeds whose key rows are on disk at a time; pairs of a node that are held against their sets before the others.
PASS, FORE = 4, 4


def _pairs(a: np.ndarray, b: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
    """PAIRS: pairs, then keys."""
    n, m = len(a), len(key)
    columns = [pa.concat_arrays([pa.array(x, pa.int64()), pa.nulls(m, pa.int64())]) for x in (np.minimum(a, b), np.maximum(a, b))]
    return pa.RecordBatch.from_arrays([*columns, pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(key, pa.int64())])], names=["a", "b", "key"])


def _alike(sizes: tuple[np.ndarray, np.ndarray], least: float) -> np.ndarray:
    """Whether sets of these sizes can have that similarity."""
    return np.minimum(*sizes) >= least * np.maximum(*sizes)


def neighbour_pairs(batches: Iterable[pa.RecordBatch], radius: int, segments: int, least: float, reach: int) -> Iterator[pa.RecordBatch]:
    """batches: key, fingerprint, node, size, in the order of key and fingerprint. PAIRS: rows of a bucket up to `reach` places apart that link; and the keys of buckets that have more pairs than these."""
    per_start, value_bits = len(key_choices(radius, segments)), np.uint64(tables(radius, segments)[1])
    tail: list[np.ndarray] = [np.empty(0, np.int64)] * 4
    rank = 0  # rows of the open bucket that came before the tail's first
    for batch in batches:
        if not batch.num_rows:
            continue
        old = len(tail[0])
        key, fp, node, size = now = [np.concatenate((t, c.to_numpy(zero_copy_only=False))) for t, c in zip(tail, batch.columns)]
        begin = ((key.view(np.uint64) >> value_bits) // np.uint64(per_start) % np.uint64(segments)).astype(np.int64)
        bits, a, b = fp.view(np.uint64), [], []
        for d in range(1, reach + 1):
            i = np.arange(max(0, old - d), len(key) - d)
            i = i[(key[i] == key[i + d]) & _alike((size[i], size[i + d]), least)]
            if len(i):
                i = i[linked(bits[i], bits[i + d], begin[i], radius, segments)]
                a.append(node[i])
                b.append(node[i + d])
        first = np.concatenate(([True], key[1:] != key[:-1]))
        place = np.arange(len(key)) - np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
        place[key == key[0]] += rank
        new = np.arange(len(key)) >= old
        yield _pairs(np.concatenate([*a, node[:0]]), np.concatenate([*b, node[:0]]), key[new & (place == reach + 1)])
        keep = min(reach, len(key))
        tail = [x[-keep:] for x in now]
        rank = int(place[-keep]) if key[-keep] == key[-1] else 0
        if key[-keep] != key[-1]:
            own = tail[0] == key[-1]
            tail = [x[own] for x in tail]


#: Bytes of a sketch.
SKETCH = 128


def sketch(shingles: np.ndarray) -> bytes:
    """One bit for each place: whether an odd number of the set's shingles falls there. Two sketches differ in at most as many bits as their sets differ in shingles."""
    return np.packbits(np.bincount((shingles & np.uint64(8 * SKETCH - 1)).astype(np.int64), minlength=8 * SKETCH).astype(np.uint8) & 1).tobytes()


def _sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint64).reshape(-1, SKETCH // 8)


def _may_be_similar(a: np.ndarray, b: np.ndarray, sizes: tuple[np.ndarray, np.ndarray], least: float) -> np.ndarray:
    """Whether sets with these sketches and sizes can have that similarity."""
    return np.bitwise_count(a ^ b).sum(-1) <= (sizes[0] + sizes[1]) * ((1 - least) / (1 + least)) + 1e-9


def label_runs(batches: Iterable[pa.RecordBatch], least_rows: int) -> Iterator[pa.RecordBatch]:
    """batches: key, label, in their order. key, label, n: of buckets of `least_rows` or more that have several labels, how many rows each label has."""
    of, runs = None, []

    def done() -> list[tuple]:
        return [(of, label, n) for label, n in runs] if len(runs) > 1 and sum(n for _, n in runs) >= least_rows else []

    for batch in batches:
        key, label = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(key):
            continue
        first = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (label[1:] != label[:-1]))))
        length = np.diff(np.append(first, len(key)))
        # rows alone in their bucket, and not at the batch's ends, are passed by
        keys_ = key[first]
        new = np.concatenate(([True], keys_[1:] != keys_[:-1]))
        last = np.concatenate((new[1:], [True]))
        some = ~(new & last)
        some[[0, -1]] = True
        out = []
        for k, x, n in zip(keys_[some].tolist(), label[first][some].tolist(), length[some].tolist()):
            if k != of:
                out += done()
                of, runs = k, []
            if runs and runs[-1][0] == x:
                runs[-1] = (x, runs[-1][1] + n)
            else:
                runs.append((x, n))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["key", "label", "n"])
    if out := done():
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["key", "label", "n"])


def crossed_pairs(batches: Iterable[pa.RecordBatch], radius: int, least: float) -> Iterator[pa.RecordBatch]:
    """batches: group, held, node, label, size, fingerprints, sketch, in the order of group and held, those held first. a, b: of those held with all others of another label, the pairs of which any fingerprints link and whose sketches allow the similarity."""
    of, kept = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        group, mine, node, label, size = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        prints = batch.column(5).flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(node), -1)
        columns = [node, label, size, prints, _sketches(batch.column(6).to_pylist())]
        edges_at = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
        for start, end in zip(edges_at[:-1].tolist(), edges_at[1:].tolist()):
            if group[start] != of:
                of, kept = group[start], [c[:0] for c in columns]
            own = mine[start:end] == 0
            rows = [c[start:end] for c in columns]
            kept = [np.concatenate((k, r[own])) for k, r in zip(kept, rows)]
            others = [r[~own] for r in rows]
            a, b = [], []
            for k in range(len(kept[0])) if len(others[0]) else ():
                fit = np.flatnonzero((others[1] != kept[1][k]) & _alike((others[2], kept[2][k]), least))
                fit = fit[(np.bitwise_count(others[3][fit] ^ kept[3][k]) <= radius).any(1)]
                fit = fit[_may_be_similar(others[4][fit], kept[4][k], (others[2][fit], kept[2][k]), least)]
                a.append(np.full(len(fit), kept[0][k]))
                b.append(others[0][fit])
            if a:
                a, b = np.concatenate(a), np.concatenate(b)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _texts(docs: DataFrame, id_column: str, text_column: str, *more) -> DataFrame:
    """has, id, h (whether a row has an id, the id, a hash of the text: together a row's identity), text and more."""
    id_, text = docs[id_column].cast("long"), F.coalesce(docs[text_column].cast("string"), F.lit(""))
    return docs.select(id_.isNotNull().alias("has"), F.coalesce(id_, F.lit(0)).alias("id"), F.xxhash64(text).alias("h"), text.alias("text"), *more)


IDENTITY = ["has", "id", "h"]


def _sets(pairs: DataFrame, texts: DataFrame, rep: DataFrame, shingle: int) -> DataFrame:
    """node, hashes: the sets of shingles of the pairs' nodes. texts: of _texts(); rep: node and the IDENTITY of a row with its text."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(rep, "node")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            found = [np.unique(shingle_hashes(t, shingle)).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["node", "hashes"])

    wanted = texts.join(nodes, IDENTITY).select("node", "text")
    return wanted.mapInArrow(run, "node long, hashes binary").dropDuplicates(["node"])


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs a, b of nodes whose sets (of _sets()) have a Jaccard similarity of `least` or more."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b").select("a", "b", "x", "y")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                both = np.sort(np.concatenate((x, y)), kind="stable")
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(shared >= least * (len(both) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def apart(pairs: DataFrame, near: DataFrame) -> DataFrame:
    """The pairs a, b that links in near don't connect."""
    groups = components(near)
    side = lambda c: groups.select(F.col("node").alias(c), F.col("component").alias(f"{c}_label"))
    return pairs.join(side("a"), "a", "left").join(side("b"), "b", "left").where(F.coalesce("a_label", "a") != F.coalesce("b_label", "b")).select("a", "b")


def joined_by(pairs: DataFrame, near: DataFrame | None, texts: DataFrame, rep: DataFrame, shingle: int, least: float) -> DataFrame:
    """near (links a, b) and of the pairs those verified() that connect more. A few pairs of each node come first: in a group of near copies they connect most, and pairs within a group needn't have their sets sent."""
    order = Window.partitionBy("a").orderBy(F.xxhash64("a", "b"))
    ranked = stored(pairs.withColumn("rank", F.row_number().over(order)))
    sets = stored(_sets(ranked, texts, rep, shingle))
    first = stored(verified(ranked.where(F.col("rank") <= FORE).select("a", "b"), sets, least))
    near = first if near is None else near.unionByName(first)
    rest = ranked.where(F.col("rank") > FORE).select("a", "b")
    return near if rest.isEmpty() else near.unionByName(stored(verified(stored(apart(rest, near)), sets, least)))


def _profiles(texts: DataFrame, shingle: int, seeds: int) -> DataFrame:
    """IDENTITY, digest (of the set of shingles), size (of the set), sketch (of the set), fingerprints (by seed)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest, xxh64_intdigest

        memo = worker_kept("word hashes", lambda: Memo(lambda word: xxh64_intdigest(word, SEED)))
        for batch in slices(batches, 256):
            digests, sizes, sketches, found = [], [], [], []
            for text in batch.column(3).to_pylist():
                own = np.unique(shingle_hashes(text, shingle))
                digests.append(xxh3_128_digest(own.tobytes()))
                sketches.append(sketch(own))
                sizes.append(len(own))
                counts = Counter(text.encode().lower().split())
                hashes = np.fromiter((memo[w] for w in counts), np.uint64, len(counts))
                found += weighted_votes(hashes, np.array([n.bit_length() for n in counts.values()], np.int64), seeds)
            values = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary()), pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * seeds, values)], names=[*IDENTITY, "digest", "size", "sketch", "fingerprints"])

    return texts.select(*IDENTITY, "text").mapInArrow(run, "has boolean, id long, h long, digest binary, size long, sketch binary, fingerprints array<long>")


def _groups(texts: DataFrame, radius: int, segments: int, seeds: int, shingle: int, least: float, block: int) -> tuple[DataFrame, DataFrame]:
    """texts: of _texts(). Profiles of all rows; and digest, first: the first IDENTITY (ids before nulls, then the smallest) of the group that a set of shingles belongs to."""
    found = stored(_profiles(texts, shingle, seeds))
    first = F.min(F.struct((~F.col("has")).alias("none"), "id", "h")).alias("first")
    classes = found.groupBy("digest").agg(first, F.max("size").alias("size"), F.max("sketch").alias("sketch"), F.max("fingerprints").alias("fingerprints"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()))
    rep = classes.select("node", (~F.col("first.none")).alias("has"), F.col("first.id").alias("id"), F.col("first.h").alias("h"))
    count, value_bits = tables(radius, segments)

    passes = range(0, seeds, PASS)

    def key_rows(of: DataFrame, low: int, *columns: str) -> DataFrame:
        """key, fingerprint and the columns: a row for each table and each seed of the pass that begins at low."""
        by_seed = of.select(*columns, F.posexplode(F.slice("fingerprints", low + 1, PASS)).alias("seed", "fingerprint"))
        at = F.shiftleft(((F.col("seed") + low) * count).cast("long"), value_bits)
        return by_seed.select(F.explode(F.transform(keys(F.col("fingerprint"), radius, segments), lambda k: k + at)).alias("key"), "fingerprint", *columns)

    def sketched(pairs: DataFrame) -> DataFrame:
        """Pairs whose sketches allow the similarity."""
        side = lambda c, x: classes.select(F.col("node").alias(c), F.col("size").alias(f"{x}n"), F.col("sketch").alias(f"{x}s"))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n, m = (batch.column(i).to_numpy() for i in (2, 4))
                keep = _may_be_similar(_sketches(batch.column(3).to_pylist()), _sketches(batch.column(5).to_pylist()), (n, m), least)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

        return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "xn", "xs", "yn", "ys").mapInArrow(run, "a long, b long")

    # neighbours within a bucket first
    found_pairs, larger = None, False
    for low in passes:
        dealt = key_rows(classes, low, "node", "size").select("key", "fingerprint", "node", "size").repartition("key").sortWithinPartitions("key", "fingerprint")
        got = stored(dealt.mapInArrow(lambda batches: neighbour_pairs(batches, radius, segments, least, REACH), PAIRS))
        larger = larger or not got.where("key is not null").isEmpty()
        some = got.where("a is not null").select("a", "b")
        found_pairs = some if found_pairs is None else found_pairs.unionByName(some)
    near = joined_by(sketched(found_pairs.distinct()), None, texts, rep, shingle, least)
    if larger:
        # then what larger buckets hold besides: where groups so far (labels) meet in one, all but the largest of them are held against all
        groups = components(near).withColumnRenamed("node", "of")
        labelled = stored(classes.join(groups, F.col("node") == F.col("of"), "left").select("node", F.coalesce("component", "node").alias("label"), "size", "fingerprints", "sketch"))
        runs = None
        for low in passes:
            dealt = key_rows(labelled, low, "label").select("key", "label").repartition("key").sortWithinPartitions("key", "label")
            some = stored(dealt.mapInArrow(lambda batches: label_runs(batches, REACH + 2), "key long, label long, n long"))
            runs = some if runs is None else runs.unionByName(some)
        mains = runs.groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("main"))
        met = runs.join(mains, "key").where("label <> main").select(F.col("label").alias("a"), F.col("main").alias("b")).distinct()
        # groups that meet anywhere are one cluster, in which each document stands once
        clusters = components(met).select(F.col("node").alias("label"), F.col("component").alias("cluster"))
        rows = stored(labelled.join(clusters, "label"))
        sizes = rows.groupBy("cluster", "label").agg(F.count("*").alias("n")).groupBy("cluster").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.max("n").alias("n_main"), F.sum("n").alias("n"))
        sizes = sizes.select("cluster", "main", F.ceil(F.col("n") / (16 * block)).cast("int").alias("parts"), F.ceil((F.col("n") - F.col("n_main")) / block).cast("int").alias("blocks"))
        mixed = rows.join(sizes, "cluster")
        at, every = F.xxhash64("node", F.lit(1)), lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        columns = ["node", "label", "size", "fingerprints", "sketch"]
        holds = mixed.where("label <> main").select("cluster", F.lit(0).alias("held"), *columns, F.pmod(at, F.col("blocks")).cast("int").alias("i"), every("parts").alias("j"))
        meets = mixed.select("cluster", F.lit(1).alias("held"), *columns, every("blocks").alias("i"), F.pmod(at, F.col("parts")).cast("int").alias("j"))
        both = holds.unionByName(meets).select(F.xxhash64("cluster", "i", "j").alias("group"), "held", *columns)
        dealt = both.repartition("group").sortWithinPartitions("group", "held")
        more = stored(dealt.mapInArrow(lambda batches: crossed_pairs(batches, radius, least), "a long, b long").distinct())
        near = joined_by(more, near, texts, rep, shingle, least)
    groups = components(near).withColumnRenamed("node", "of")
    named = stored(classes.join(groups, F.col("node") == F.col("of"), "left").select("digest", "first", F.coalesce("component", "node").alias("component")))
    firsts = named.groupBy("component").agg(F.min("first").alias("first"))
    return found, named.select("digest", "component").join(firsts, "component").select("digest", "first")


def similar_documents(docs: DataFrame, radius: int = 3, segments: int = 8, seeds: int = 8, shingle: int = 5, least: float = 0.8, block: int = 4096, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, component_id: the smallest doc_id that links reach. Documents link if the Jaccard similarity of their sets of `shingle` words is `least` or more; the fingerprints of any seed only lead to the pairs that are held against it.

    Equal sets are one node. Candidates are first the neighbours within a bucket, sought for a few seeds at a time. Then, where groups still meet in larger
    buckets, the documents of all but the largest are held against all of these, in blocks of `block` rows, so that a large group of
    near copies doesn't cost its pairs. Sketches of the sets drop pairs that can't be similar enough, before their sets are compared.
    """
    _check(radius, segments)
    found, groups = _groups(_texts(docs, id_column, text_column), radius, segments, seeds, shingle, least, block)
    return found.join(groups, "digest").select(F.when(F.col("has"), F.col("id")).alias("doc_id"), F.when(~F.col("first.none"), F.col("first.id")).alias("component_id"))


def first_of_each(docs: DataFrame, radius: int = 3, segments: int = 8, seeds: int = 8, shingle: int = 5, least: float = 0.8, block: int = 4096, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The columns of docs, one row of each group of similar_documents(): the one with the smallest id (a null only where no row has an id); of rows with that id the one whose text has the smallest hash; of rows that have id and text in common, one of them."""
    _check(radius, segments)
    texts = _texts(docs, id_column, text_column)
    _, groups = _groups(texts, radius, segments, seeds, shingle, least, block)
    firsts = groups.select((~F.col("first.none")).alias("has"), F.col("first.id").alias("id"), F.col("first.h").alias("h")).distinct()
    rows = _texts(docs, id_column, text_column, F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc")).select(*IDENTITY, "doc").dropDuplicates(IDENTITY)
    return rows.join(firsts, IDENTITY, "left_semi").select("doc.*")
