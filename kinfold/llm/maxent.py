"""A hashed maximum-entropy language model with a class-factored softmax.

P(token | history) = P(class | history) * P(member | class, history): two softmax steps of `WIDTH` each. The commonest
tokens are members of their own, in classes by rank; the members of the last class are groups of all other
tokens, by their endings. A group's commonest tokens are places of two steps more (`Deep`): of classes within the group, the last of which is
for the rest, and of members. In the rest a token has its count plus one, and one more place is kept for what
training has not seen, so the model is a proper distribution, and any token has its place in it, known or not.

Features of a history are those of the tokens themselves: the one before (bigram) and, for the class, the one before that (skip) and
both together (trigram), each with the step it is for hashed into a row of a table of weights; and each step has a bias. The steps
within groups have a table of their own.
Weights start from the tokens' shares (the biases) and zeros. Training goes over the documents in `rounds` mini-batches,
each document in one. In a round every partition sums the gradient over its documents of the batch, by row of the table; the sums
meet in a shuffle, and the driver, which holds the table, takes a step scaled by how often a row was active.

What is gathered grows with the corpus: token counts are a distributed table, of which only the `common` most frequent
tokens are sent to the tasks; the rest meet their counts in a join. The table of weights is bounded by `buckets`.

Defined results: a null or empty text is its end token alone. Null ids are held
out of training. With nothing to train on every token is unknown. Every row is a text and gives a row, as often as it comes and
with null ids too; rows that share an id are each scored by themselves. Of tokens with one count the smaller is the more common. An
empty table gives an empty one. Further columns take no part, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, text_slices

#: The end token. No word is empty.
END = ""
LOG10 = math.log(10)
#: Choices of a softmax step; tokens whose scores are worked on together, few enough for a core's cache; tokens whose rows are put in order together.
WIDTH, CHUNK, LARGE = 32, 1 << 12, 1 << 17
#: Tokens that can have a place of their own: by themselves, and in groups.
OWN = WIDTH * (WIDTH - 1) * (1 + WIDTH)
#: Share of a row's own step, for a score is the sum of several rows; counts that a row starts from.
STEP, PRIOR = 1 / 3, 2.0


def tokens(text: str | None) -> list[bytes]:
    """Words, A-Z lower-cased, and the end."""
    return [*(text or "").encode().lower().split(), b""]


def split_tokens(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """tokens() of an array's texts, one after another, and each text's number of them."""
    empty, space = (pa.scalar(x, texts.type) for x in ("", " "))
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, empty)))
    # after a last space the empty end follows; an empty text is split into it alone
    found = pc.ascii_split_whitespace(pc.if_else(pc.equal(trimmed, empty), trimmed, pc.binary_join_element_wise(trimmed, empty, space)))
    return pc.list_value_length(found).to_numpy().astype(np.int64), found.flatten()


def _words(distinct: pa.Array) -> list[bytes]:
    """to_pylist() of words, sooner: they have no spaces."""
    whole = pa.ListArray.from_arrays(pa.array([0, len(distinct)], pa.int32()), distinct)
    return pc.binary_join(whole, b" ")[0].as_buffer().to_pybytes().split(b" ")


class Classes:
    """Places of tokens: class * WIDTH + member. own: tokens with a place of their own, the commonest first; endings: groups of the others in the last class, whose last member is for the rest. within: more tokens, the commonest first, of which `room` get places within their groups as long as those have any."""

    def __init__(self, own: list[str], endings: list[str], width: int = 2, within: Iterable[str] = (), room: int = 0):
        self.own, self.endings, self.width = own[: WIDTH * (WIDTH - 1)], endings[: WIDTH - 1], width
        self.places = {w.encode(): i for i, w in enumerate(self.own)}
        self.groups = {e: WIDTH * (WIDTH - 1) + i for i, e in enumerate(self.endings)}
        self.other = WIDTH * WIDTH - 1
        self.within, used = {}, Counter()
        for word in map(str.encode, within):
            place = self.group_of(word)
            if used[place] < WIDTH * (WIDTH - 1) and len(self.within) < room:
                self.within[word] = used[place]
                used[place] += 1

    def path(self, word: bytes) -> int:
        """of(), and times WIDTH * WIDTH the place within the group; that of the last class there is for tokens without one."""
        place = self.of(word)
        return place if place < WIDTH * (WIDTH - 1) else place + WIDTH * WIDTH * self.within.get(word, WIDTH * (WIDTH - 1))

    def group_of(self, word: bytes) -> int:
        return self.groups.get(word.decode()[-self.width :], self.other)

    def of(self, word: bytes) -> int:
        found = self.places.get(word)
        return self.group_of(word) if found is None else found

    def group_column(self, word: Column) -> Column:
        """group_of() of a column."""
        if not self.groups:
            return F.lit(self.other)
        table = F.create_map(*[F.lit(x) for pair in self.groups.items() for x in pair])
        return F.coalesce(F.try_element_at(table, F.right(word, F.lit(self.width))), F.lit(self.other))


def count_tokens(docs: DataFrame, held: int = 600_000) -> DataFrame:
    """token, c: over all rows of docs (doc_id, text). A task that has more than `held` tokens gives them out."""

    def merged(parts: list[pa.Table]) -> pa.Table:
        whole = pa.concat_tables(parts)
        parts.clear()
        whole = whole.group_by("token", use_threads=False).aggregate([("c", "sum")]).select(["token", "c_sum"]).rename_columns(["token", "c"])
        pa.default_memory_pool().release_unused()  # the worker's next tasks need the memory for other things
        return whole

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows = [], 0
        for batch in text_slices(batches):
            found = split_tokens(batch.column(1))[1].value_counts()
            parts.append(pa.table({"token": found.field(0), "c": found.field(1)}))
            rows += len(found)
            if rows > 2 * held:
                parts.append(merged(parts))
                rows = len(parts[0])
                if rows > held:
                    yield from parts.pop().to_batches(max_chunksize=50_000)
                    rows = 0
        if parts:
            yield from merged(parts).to_batches(max_chunksize=50_000)
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, "token string, c long").groupBy("token").agg(F.sum("c").alias("c"))


def _mixed(step: np.ndarray, kind: int, one: np.ndarray, two: np.ndarray | None = None) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (step.astype(np.uint64) * np.uint64(8) + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15) + one * np.uint64(0xC2B2AE3D27D4EB4F)
        if two is not None:
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93) + two
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x >> np.uint64(33)


def contexts(step: np.ndarray, row: np.ndarray, steps: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of step and row that occur, in the order of their rows, how often they do, and for each token which pair is its own."""
    key, width = row * np.int64(steps) + step, steps * rows
    if width > max(8 * len(key), 1 << 20):  # a table of all pairs would be mostly empty
        pairs, own, times = np.unique(key, return_inverse=True, return_counts=True)
    else:
        counts = np.bincount(key, minlength=width)
        pairs = np.flatnonzero(counts)
        times, place = counts[pairs], np.empty(width, np.int32)
        place[pairs] = np.arange(len(pairs), dtype=np.int32)
        own = place[key]
    return np.stack((pairs % steps, pairs // steps)), times, own


def _hashed(buckets: int, *x) -> np.ndarray:
    found = _mixed(*x)
    found = found & np.uint64(buckets - 1) if buckets & (buckets - 1) == 0 else found % np.uint64(buckets)
    return found.astype(np.int32)


def _row_sums(x: np.ndarray) -> np.ndarray:
    return x @ np.ones(x.shape[1], x.dtype)


def _order(row: np.ndarray, rows: int) -> np.ndarray:
    return np.argsort(row.astype(np.uint16) if rows <= 1 << 16 else row, kind="stable")


def _add_runs(row: np.ndarray, x: np.ndarray, sums: np.ndarray, order: np.ndarray | None = None) -> None:
    """Adds rows of x to the rows of sums that row has, which are in order or come so by order. Two numbers are added at a time, as a complex one, and as many rows as stay in the cache."""
    pairs = np.complex64 if x.dtype == np.float32 else np.complex128
    for at in range(0, len(row), CHUNK):
        part = slice(at, at + CHUNK)
        r, some = (row[part], x[part]) if order is None else (row[order[part]], x.take(order[part], axis=0))
        first = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
        sums[r[first]] += np.add.reduceat(some.view(pairs), first, axis=0).view(x.dtype)


@dataclass
class Model:
    """weights: rows of WIDTH. Row 0 is the class step's bias, row 1 + c that of class c's step; then come the hashed rows."""

    weights: np.ndarray

    @classmethod
    def new(cls, buckets: int, shares: np.ndarray) -> Model:
        """shares: of the places. Places without any count have no probability."""
        table = shares.reshape(WIDTH, WIDTH)
        with np.errstate(divide="ignore", invalid="ignore"):
            bias = np.log(np.concatenate((table.sum(1)[None], table)))
        return cls(np.concatenate((np.maximum(np.where(np.isnan(bias), -1e4, bias), -1e4), np.zeros((buckets, WIDTH)))).astype(np.float32))

    def rows(self, place: np.ndarray, before: np.ndarray, last: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Active rows of the class step and of the member step, for places after the tokens with these hashes."""
        buckets, first = len(self.weights) - WIDTH - 1, WIDTH + 1
        top, own = np.zeros(len(place), np.int32), (1 + place // WIDTH).astype(np.int32)

        def hashed(*x) -> np.ndarray:
            return _hashed(buckets, *x) + first

        return [top, hashed(top, 1, last), hashed(top, 2, before), hashed(top, 3, last, before)], [own, hashed(own, 1, last)]

    def plain(self) -> bool:
        """Whether sums of rows are so small that their powers need no scaling."""
        bias, hashed = self.weights[: WIDTH + 1], self.weights[WIDTH + 1 :]
        return bool(bias.max() + 3 * hashed.max(initial=0) < 60 and bias.max(1).min() + 3 * hashed.min(initial=0) > -60)

    def scores(self, rows: list[np.ndarray], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """A step's scores, and their powers."""
        scores = self.weights.take(rows[0], axis=0)
        for r in rows[1:]:
            scores += self.weights.take(r, axis=0)
        if not plain:
            scores -= scores.max(axis=1, keepdims=True)
        return scores, np.exp(scores)

    def score(self, place: np.ndarray, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Log-probability of each place."""
        out, plain = np.empty(len(place)), self.plain()
        (own, hashed), pairs = [np.empty(len(place), np.int32) for _ in range(2)], place // WIDTH
        for at in range(0, len(place), CHUNK):
            cut = slice(at, at + CHUNK)
            p = place[cut]
            n = np.arange(len(p))
            rows, (own[cut], hashed[cut]) = self.rows(p, before[cut], last[cut])
            scores, powers = self.scores(rows, plain)
            out[cut] = scores[n, pairs[cut]].astype(float) - np.log(_row_sums(powers).astype(float))
        # a member step's scores depend on the class and the token before only, so each pair of them is worked out once
        first = WIDTH + 1
        pairs, _, which = contexts(own - 1, hashed - first, WIDTH, len(self.weights) - first)
        pairs += np.array([[1], [first]])
        total = np.empty(pairs.shape[1])
        for at in range(0, len(total), CHUNK):
            total[at : at + CHUNK] = self.totals(pairs[:, at : at + CHUNK], plain)[1]
        seen = place % WIDTH
        return out + self.weights[own, seen] + self.weights[hashed, seen] - total[which]

    def totals(self, rows: np.ndarray, plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """A step's probabilities, and the logarithms of the sums that they were divided by."""
        scores = self.weights.take(rows[0], axis=0)
        for r in rows[1:]:
            scores += self.weights.take(r, axis=0)
        most = 0.0
        if not plain:
            most = scores.max(axis=1)
            scores -= most[:, None]
        powers = np.exp(scores, out=scores)
        whole = _row_sums(powers)
        powers *= (1 / whole)[:, None]
        return powers, np.log(whole.astype(float)) + most

    def gradient(self, place: np.ndarray, before: np.ndarray, last: np.ndarray, sums: np.ndarray, active: np.ndarray) -> float:
        """Adds to sums what was observed less what is expected, by row, and to active how often a row was; gives the log-likelihood."""
        value, plain, first = 0.0, self.plain(), WIDTH + 1
        own, hashed = [np.empty(len(place), np.int32) for _ in range(2)]
        pairs, off = place // WIDTH, np.empty((min(len(place), LARGE), WIDTH), self.weights.dtype)
        for at in range(0, len(place), LARGE):
            cut = slice(at, at + LARGE)
            rows, (own[cut], hashed[cut]) = self.rows(place[cut], before[cut], last[cut])
            for start in range(0, len(rows[0]), CHUNK):
                part, seen = slice(start, start + CHUNK), pairs[cut][start : start + CHUNK]
                n = np.arange(len(seen))
                scores, powers = self.scores([r[part] for r in rows], plain)
                whole = _row_sums(powers)
                value += float(scores[n, seen].sum(dtype=float) - np.log(whole).sum(dtype=float))
                powers *= (-1 / whole)[:, None]
                powers[n, seen] += 1
                sums[0] += np.ones(len(n), powers.dtype) @ powers
                off[: len(rows[0])][part] = powers
            active[0] += len(rows[0])
            for r in rows[1:]:
                _add_runs(r, off, sums, _order(r, len(self.weights)))
                active[first:] += np.bincount(r - first, minlength=len(active) - first)
        # the member step: what was observed is counted; what is expected depends on the class and the token before only
        seen = place % WIDTH
        value += float(self.weights[own, seen].sum(dtype=float) + self.weights[hashed, seen].sum(dtype=float))
        sums[1:first] += np.bincount(place, minlength=WIDTH * WIDTH).reshape(WIDTH, WIDTH)
        sums[first:] += np.bincount((hashed - first) * np.int64(WIDTH) + seen, minlength=sums[first:].size).reshape(-1, WIDTH)
        active[1:first] += np.bincount(own - 1, minlength=WIDTH)
        active[first:] += np.bincount(hashed - first, minlength=len(active) - first)
        pairs, times, _ = contexts(own - 1, hashed - first, WIDTH, len(self.weights) - first)
        pairs += np.array([[1], [first]])
        for at in range(0, len(times), CHUNK):
            rows, n = pairs[:, at : at + CHUNK], times[at : at + CHUNK]
            expected, total = self.totals(rows, plain)
            value -= float(n @ total)
            expected *= -n.astype(expected.dtype)[:, None]
            sums[1:first] += np.eye(WIDTH, dtype=expected.dtype)[rows[0] - 1].T @ expected
            _add_runs(rows[1], expected, sums)
        return value

    def step(self, sums: np.ndarray, active: np.ndarray) -> None:
        """One update by a batch's gradient: close to Newton's for a single row, whose curvature is its expected counts."""
        share = np.exp(self.weights[: WIDTH + 1] - self.weights[: WIDTH + 1].max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        expected = np.repeat(active[:, None] / WIDTH, WIDTH, axis=1)
        expected[: WIDTH + 1] = active[: WIDTH + 1, None] * share
        self.weights += (STEP * sums / (expected + 0.5 * np.abs(sums) + PRIOR)).astype(np.float32)


class Deep(Model):
    """The steps within groups: weights begin with the biases of each group's classes, then of each class's members; then come the hashed rows, by step and the token before."""

    BIASES = WIDTH + WIDTH * WIDTH

    @classmethod
    def new(cls, buckets: int, shares: np.ndarray) -> Deep:
        """shares: by group and place in it; those of the last class are all of the rest. A step without tokens has all choices alike."""
        shares = shares.reshape(WIDTH, WIDTH, WIDTH)
        with np.errstate(divide="ignore", invalid="ignore"):
            bias = np.log(np.concatenate((shares.sum(2), shares.reshape(-1, WIDTH))))
        bias[~(bias > -np.inf).any(1)] = 0
        return cls(np.concatenate((np.maximum(np.where(np.isnan(bias), -1e4, bias), -1e4), np.zeros((buckets, WIDTH)))).astype(np.float32))

    def plain(self) -> bool:
        most, hashed = self.weights[: self.BIASES].max(1), self.weights[self.BIASES :]
        return bool(most.max() + hashed.max(initial=0) < 60 and most.min() + hashed.min(initial=0) > -60)

    def steps(self, path: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Of each step: which tokens take it, its bias, hashed row and choice; and the number of its biases, the first of them."""
        buckets = len(self.weights) - self.BIASES
        inside = np.flatnonzero((path & (WIDTH * WIDTH - 1)) >= WIDTH * (WIDTH - 1))
        group, place = path[inside] & (WIDTH - 1), path[inside] // (WIDTH * WIDTH)
        yield inside, group, _hashed(buckets, group, 4, last[inside]), place // WIDTH, WIDTH, 0
        own = place < WIDTH * (WIDTH - 1)
        inside, node, choice = inside[own], group[own] * WIDTH + place[own] // WIDTH, place[own] % WIDTH
        yield inside, node, _hashed(buckets, node, 5, last[inside]), choice, WIDTH * WIDTH, WIDTH

    def score(self, path: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Log-probability of each place within its group; 0 of tokens in none."""
        out, weights, plain = np.zeros(len(path)), self.weights, self.plain()
        for which, step, row, choice, steps, first in self.steps(path, last):
            pairs, own = (first + step, self.BIASES + row), slice(None)
            if steps == WIDTH:  # of members few histories come twice
                pairs, _, own = contexts(step, row, steps, len(weights) - self.BIASES)
                pairs += np.array([[first], [self.BIASES]])
            total = np.empty(len(pairs[0]))
            for at in range(0, len(total), CHUNK):
                total[at : at + CHUNK] = self.totals([x[at : at + CHUNK] for x in pairs], plain)[1]
            out[which] += weights[first + step, choice] + weights[self.BIASES + row, choice] - total[own]
        return out

    def gradient(self, path: np.ndarray, last: np.ndarray, sums: np.ndarray, active: np.ndarray) -> float:
        """As Model's."""
        value, weights, plain = 0.0, self.weights, self.plain()
        for which, step, row, choice, steps, first in self.steps(path, last):
            if not len(which):
                continue
            for r in (first + step, self.BIASES + row):
                value += float(weights[r, choice].sum(dtype=float))
                low, high = int(r.min()), int(r.max()) + 1
                active[low:high] += np.bincount(r - low, minlength=high - low)
                sums[low:high] += np.bincount((r - low) * np.int64(WIDTH) + choice, minlength=(high - low) * WIDTH).reshape(-1, WIDTH)
            if steps == WIDTH:
                pairs, times, _ = contexts(step, row, steps, len(weights) - self.BIASES)
                pairs += np.array([[first], [self.BIASES]])
            else:
                order = _order(row, len(weights))
                pairs, times = np.stack((first + step[order], self.BIASES + row[order])), np.ones(len(order))
            off = np.empty((min(len(times), LARGE), WIDTH), weights.dtype)
            for at in range(0, len(times), LARGE):
                rows = pairs[:, at : at + LARGE]
                for start in range(0, rows.shape[1], CHUNK):
                    some, n = rows[:, start : start + CHUNK], times[at + start : at + LARGE][:CHUNK]
                    expected, total = self.totals(some, plain)
                    value -= float(n @ total)
                    expected *= -n.astype(expected.dtype)[:, None]
                    off[start : start + len(n)] = expected
                _add_runs(rows[0], off, sums, _order(rows[0], self.BIASES))
                _add_runs(rows[1], off[: rows.shape[1]], sums)
        return value

    def step(self, sums: np.ndarray, active: np.ndarray) -> None:
        bias = self.weights[: self.BIASES]
        share = np.exp(bias - bias.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        expected = np.repeat(active[:, None] / WIDTH, WIDTH, axis=1)
        expected[: self.BIASES] = active[: self.BIASES, None] * share
        self.weights += (STEP * sums / (expected + 0.5 * np.abs(sums) + PRIOR)).astype(np.float32)


class Encoder(dict):
    """Numbers of words; by number their path, their hash and the logarithm of their count plus one (-1 for those that aren't in top)."""

    BOUND, HELD = 400_000, 1 << 25

    def __init__(self, classes: Classes, top: dict[bytes, int] | None = None):
        super().__init__()
        self.classes, self.top = classes, top or {}
        self.fixed = classes.places | {word: classes.path(word) for word in classes.within}
        self.tails: dict[bytes, int] = {}  # paths of all other words by their last letters, where those are ASCII
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.held, self.known, self.gains, self.words = 0, array("q"), array("d"), []

    def paths(self, words: list[bytes]) -> np.ndarray:
        found = np.fromiter(map(self.fixed.get, words, repeat(-1)), np.int64, len(words))
        at, width = np.flatnonzero(found < 0), self.classes.width
        rest = [words[i] for i in at.tolist()]
        by_tail = map(self.tails.get, [w[-width:] for w in rest])
        found[at] = [self.tail_path(w) if path is None else path for w, path in zip(rest, by_tail)]
        return found

    def tail_path(self, word: bytes) -> int:
        path, tail = self.classes.path(word), word[-self.classes.width :]
        if tail.isascii():
            self.tails[tail] = path
        return path

    def learn(self) -> None:
        """What is kept of words that have a number only."""
        new = self.words[len(self.known) :]
        self.update(zip(new, range(len(self), len(self.words))))
        self.held += sum(map(len, new))
        crc = np.fromiter(map(zlib.crc32, new), np.int64, len(new))
        self.known.frombytes(((crc + 1) << 24 | self.paths(new)).tobytes())
        if self.top:
            counts = np.fromiter(map(self.top.get, new, repeat(-1)), np.int64, len(new))
            self.gains.frombytes(np.where(counts < 0, -1.0, np.log10(np.maximum(counts, 0) + 1.0)).tobytes())
        else:
            self.gains.frombytes(np.full(len(new), -1.0).tobytes())

    def encode(self, texts: list[list[bytes]]) -> tuple[np.ndarray, ...]:
        """encode_words() of tokens by text."""
        return self.encode_words(np.fromiter(map(len, texts), np.int64, len(texts)), pa.array(chain.from_iterable(texts), pa.binary()))

    def encode_words(self, lengths: np.ndarray, words: pa.Array) -> tuple[np.ndarray, ...]:
        """Of texts one after another, as split_tokens() gives them: paths, hashes of the token before the last and of the last one (0 where there is none), gains, numbers, and where texts begin. Empties itself between calls, so that memory stays level."""
        if len(self) > self.BOUND or self.held > self.HELD:
            self.reset()
        found = words.cast(pa.binary()).dictionary_encode()
        distinct = _words(found.dictionary)
        numbers = np.fromiter(map(self.get, distinct, repeat(-1)), np.int64, len(distinct))
        at = np.flatnonzero(numbers < 0)
        numbers[at] = np.arange(len(self), len(self) + len(at))
        self.words.extend(map(distinct.__getitem__, at.tolist()))
        self.learn()
        numbers = numbers[found.indices.to_numpy()]
        both = np.frombuffer(self.known, np.int64)[numbers]
        gains = np.frombuffer(self.gains, float)[numbers]
        hashes, starts = (both >> 24).astype(np.uint64), np.cumsum(lengths) - lengths
        last, before = np.zeros_like(hashes), np.zeros_like(hashes)
        last[1:], before[2:] = hashes[:-1], hashes[:-2]
        last[starts] = before[starts] = 0
        before[starts[lengths > 1] + 1] = 0
        return both & 0xFFFFFF, before, last, gains, numbers, starts


def train(docs: DataFrame, classes: Classes, model: Model, deep: Deep | None, rounds: int) -> list[float]:
    """docs: doc_id, text. Updates the model and, if there is one, deep, whose rows come after the model's; gives each round's mean log-likelihood of a token, over documents that it had not yet learnt from."""
    spark, likelihood = docs.sparkSession, []
    split = len(model.weights)
    whole = split + (len(deep.weights) if deep else 0)
    for done in range(rounds):
        state = spark.sparkContext.broadcast((classes, model, deep))

        def sums_of(batches: Iterable[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            classes, model, deep = state.value
            encoder = Encoder(classes)
            sums, active, total = np.zeros((whole, WIDTH), np.float32), np.zeros(whole, np.int64), 0.0
            for batch in text_slices(batches):
                path, before, last, *_ = encoder.encode_words(*split_tokens(batch.column(0)))
                total += model.gradient(path & (WIDTH * WIDTH - 1), before, last, sums[:split], active[:split])
                if deep:
                    total += deep.gradient(path, last, sums[split:], active[split:])
            row = np.flatnonzero(active)
            if len(row):
                yield pa.RecordBatch.from_arrays([pa.array(row.astype(np.int32)), pa.array([x.tobytes() for x in sums[row]], pa.binary()), pa.array(active[row]), pa.array(np.where(row == 0, total, 0.0))], names=["row", "sums", "active", "total"])

        def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, active, total = {}, Counter(), 0.0
            for batch in batches:
                total += float(batch.column(3).to_numpy().sum())
                for row, x, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                    x = np.frombuffer(x.as_buffer(), np.float32)
                    sums[row] = sums[row] + x if row in sums else x.astype(float)
                    active[row] += n
            if sums:
                first = np.zeros(len(sums))
                first[0] = total
                yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.astype(np.float32).tobytes() for x in sums.values()], pa.binary()), pa.array([active[r] for r in sums], pa.int64()), pa.array(first)], names=["row", "sums", "active", "total"])

        schema = "row int, sums binary, active long, total double"
        batch = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == done).select("text")
        got = batch.mapInArrow(sums_of, schema).repartition("row").mapInArrow(added, schema).toArrow()
        state.unpersist()
        if not got.num_rows:
            continue
        sums, active, row = np.zeros((whole, WIDTH), np.float32), np.zeros(whole, np.int64), got["row"].to_numpy()
        sums[row], active[row] = np.frombuffer(b"".join(got["sums"].to_pylist()), np.float32).reshape(-1, WIDTH), got["active"].to_numpy()
        likelihood.append(float(got["total"].to_numpy().sum()) / float(active[0]))
        model.step(sums[:split], active[:split])
        if deep:
            deep.step(sums[split:], active[split:])
    return likelihood


@dataclass
class Language:
    """What training gives. counts: token, c (a table); top: counts of the most common tokens; sizes: by place of a group, the counts and the number of its tokens without a place of their own."""

    counts: DataFrame
    n: int
    v: int
    top: dict[bytes, int]
    classes: Classes
    sizes: dict[int, int]
    model: Model
    likelihood: list[float]
    deep: Deep | None = None


def fit(training: DataFrame, common: int = 1 << 18, own: int = OWN, width: int = 2, buckets: int = 1 << 14, rounds: int = 4) -> Language:
    """training: doc_id, text.

    common, own, buckets bound what tasks and driver hold: tokens with their counts, tokens with a place of their own, hashed rows."""
    counts = stored(count_tokens(training))
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # all tokens above the least count that not more than `common` reach, then as many of the next count as there is room for
    reach = counts.groupBy("c").agg(F.count("*").alias("n")).select("c", F.sum("n").over(Window.orderBy(F.desc("c"))).alias("reached"))
    least, reached = reach.where(F.col("reached") <= common).agg(F.min("c"), F.max("reached")).first()
    above = counts.where(F.col("c") >= least) if least is not None else counts.limit(0)
    tied = counts.groupBy().agg(F.max(F.when(F.lit(least is None) | (F.col("c") < F.lit(least)), F.col("c"))).alias("next")).first()[0]
    got = above.select("token", "c").toArrow()
    top = dict(zip(got["token"].to_pylist(), got["c"].to_pylist()))
    room = common - (reached or 0)
    if tied is not None and room:
        top |= {r.token: r.c for r in counts.where(F.col("c") == tied).orderBy("token").limit(room).collect()}
    order = sorted(top, key=lambda w: (-top[w], w))
    own_words = order[: min(own, WIDTH * (WIDTH - 1))]
    if n and END not in own_words:
        own_words = [*own_words[: min(own, WIDTH * (WIDTH - 1)) - 1], END]
    if n and END not in top:  # tokens with a place of their own have their counts at hand
        top[END] = counts.where(F.col("token") == END).first().c
    names = counts.sparkSession.createDataFrame([(w,) for w in own_words], "token string")
    rest = counts.join(F.broadcast(names), "token", "left_anti")
    endings = rest.groupBy(F.right("token", F.lit(width)).alias("ending")).agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "ending").limit(WIDTH - 1).collect()
    taken = set(own_words)
    classes = Classes(own_words, [r.ending for r in endings], width, (w for w in order if w not in taken), max(0, own - WIDTH * (WIDTH - 1)))
    sizes = {r.place: r.n + r.v for r in rest.groupBy(classes.group_column(F.col("token")).alias("place")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    inside = np.zeros((WIDTH, WIDTH * WIDTH))  # by group; the rest of a group follows its own places
    for w, at in classes.within.items():
        place, c = classes.group_of(w), top[w.decode()]
        inside[place % WIDTH, at] = c
        sizes[place] -= c + 1
    sizes = {place: n for place, n in sizes.items() if n}
    shares = np.zeros(WIDTH * WIDTH)
    shares[: len(own_words)] = [top[w] for w in own_words]
    for place in range(WIDTH * (WIDTH - 1), WIDTH * WIDTH):  # a group has a place for what is unknown
        others, own_places = sizes.get(place, 0), inside[place % WIDTH].sum()
        shares[place] = others + own_places + 1 if others or own_places or place == classes.other else 0
        inside[place % WIDTH, WIDTH * (WIDTH - 1)] = others + 1
    model = Model.new(buckets, shares / shares.sum())
    deep = Deep.new(buckets, inside / inside.sum(1, keepdims=True)) if classes.within else None
    likelihood = train(training, classes, model, deep, rounds)
    return Language(counts, n, v, {w.encode(): c for w, c in top.items()}, classes, sizes, model, likelihood, deep)


def score(docs: DataFrame, held_out: Column, common: int = 1 << 18, own: int = OWN, width: int = 2, buckets: int = 1 << 14, rounds: int = 4, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10). held_out: a condition on doc_id; the other rows are learnt from."""
    kept = docs.select(docs[id_column].alias("doc_id"), docs[text_column].cast("string").alias("text"))
    language = fit(kept.where(~F.coalesce(held_out, F.lit(True))), common, own, width, buckets, rounds)
    return score_with(kept, language, held_out)


def score_with(kept: DataFrame, language: Language, held_out: Column) -> DataFrame:
    """kept: doc_id, text. The result of score()."""
    n, v = language.n, language.v
    base_total = math.log10(n + v + 1)
    sent = kept.sparkSession.sparkContext.broadcast((language.top, language.classes, language.sizes, language.model, language.deep))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, classes, sizes, model, deep = sent.value
        encoder, part, row = Encoder(classes, top), TaskContext.get().partitionId() << 40, 0
        groups = np.zeros(WIDTH * WIDTH)
        for place in range(WIDTH * (WIDTH - 1), WIDTH * WIDTH):
            groups[place] = math.log10(sizes.get(place, 0) + 1)
        in_group = WIDTH * (WIDTH - 1)
        for batch in text_slices(batches):
            lengths, words = split_tokens(batch.column(1))
            path, before, last, gain, numbers, ends = encoder.encode_words(lengths, words)
            place = path & (WIDTH * WIDTH - 1)
            rare, grouped = gain < 0, path >= in_group * (1 + WIDTH * WIDTH)
            gain[rare] = 0
            # of a token in a group's rest: its share there; the count of a rare one comes by the join
            logs = model.score(place, before, last)
            if deep:
                logs += deep.score(path, last)
            logs = logs / LOG10 + np.where(grouped, gain - groups[place], 0.0)
            total = lambda x: np.add.reduceat(x, ends)
            n_rare = total(rare.astype(np.int64))
            rows = part + row + np.arange(len(lengths))
            row += len(lengths)
            ids = batch.column(0)
            yield pa.RecordBatch.from_arrays([pa.array(rows), ids, pa.array([f" {r}" for r in rows.tolist()], pa.string()), pa.array((lengths - n_rare).astype(np.int64)), pa.array(total(gain)), pa.array(total(logs)), pa.array(lengths)], names=["row", "doc_id", "token", "times", "gain", "score", "length"])
            at = np.flatnonzero(rare)
            if len(at):
                # each text's rare tokens, counted
                cells, times = np.unique((np.searchsorted(ends, at, "right") - 1) << 32 | numbers[at], return_counts=True)
                which, words = cells >> 32, [encoder.words[i] for i in (cells & 0xFFFFFFFF).tolist()]
                zero = np.zeros(len(words))
                yield pa.RecordBatch.from_arrays([pa.array(rows[which]), ids.take(pa.array(which)), pa.array(words, pa.binary()).cast(pa.string()), pa.array(times, pa.int64()), pa.array(zero), pa.array(zero), pa.array(zero.astype(np.int64))], names=["row", "doc_id", "token", "times", "gain", "score", "length"])

    kind = kept.schema["doc_id"].dataType.simpleString()
    rows = kept.mapInArrow(run, f"row long, doc_id {kind}, token string, times long, gain double, score double, length long")
    count = F.coalesce("c", F.lit(0))
    # a text's own row has a token that is no word and meets no count; it keeps such rows apart
    text_row, more = F.col("length") > 0, F.col("times") * F.log10(count + 1)
    met = rows.join(language.counts, "token", "left").select("row", "doc_id", "length", F.when(text_row, F.col("score")).otherwise(more).alias("score"), F.when(text_row, F.col("gain")).otherwise(more).alias("gain"), F.when(text_row | (count > 0), F.col("times")).otherwise(0).alias("known"))
    summed = met.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sum("length").alias("n_tokens"), F.sum("known").alias("n_known"), F.sum("gain").alias("gain"), F.sum("score").alias("score"))
    return summed.select("doc_id", F.coalesce(held_out, F.lit(True)).alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), (F.col("gain") - F.col("n_tokens") * F.lit(base_total)).alias("base_score"), "score")
