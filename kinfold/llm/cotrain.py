"""Quality by co-training: two views of a document teach each other.

The text view sees measures of the writing and hashed words and starts of words (2^18 places); the metadata view
sees language, source and declared length. Each has a logistic classifier. Over
some rounds, each labels the documents outside of the fitted sample of which it is most
sure, in the classes' proportions, and hands them to the other as examples. At
the end each view is calibrated on labelled documents kept out of training, and
the calibrated log-odds are joined: their sum less the prior that both hold,
calibrated once more. Two such pairs are fitted: for good quality, and for toxic text.

What is learnt from labels is a bounded sample, by the order of a hash of the id: `labelled` rows (a documented parameter). The
exchange asks all other documents: their features are stored once, and each round reads them, keeps
the surest of each class, and brings `share` of the sample's size of them to the driver. Every document is scored.

Defined results: a null or empty text has measures of zero. Null or unknown
languages and sources are a category of their own. Labels that are null are
ignored, and of several for an id the greatest counts; of rows that share a labelled id one is learnt from (the greatest
features). Without labels of both classes there is nothing to learn: the scores are null, and every document is kept
as far as they are concerned. Every row gives a row and equal rows are scored alike, null ids too. An empty table gives an empty
one. Further columns take no part and stay in doc, whatever their names.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import slices, stored, text_slices, worker_kept

#: Places of hashed words; their numbers are kept as the lower 16 bits, by the upper ones.
PLACES = 1 << 18
UPPER = PLACES >> 16
#: Steps of the logarithm of a word's count, which is kept as a byte.
STEPS = 15.0
#: Letters of a word's start, which is a feature of its own.
START = 5
MEASURES = 18
META_HASHED = 48
META = META_HASHED + 4
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
HIGH = bytes(range(128, 256))
TARGETS = ("quality", "toxic")


@dataclass
class Texts:
    """Rows of the text view: measures, and words as (row, place, value), in the order of rows."""

    measures: np.ndarray
    row: np.ndarray
    place: np.ndarray
    value: np.ndarray

    def __len__(self) -> int:
        return len(self.measures)

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Texts:
        sizes = [len(r[1]) for r in rows]
        flat = lambda k, kind: np.concatenate([np.empty(0, kind), *(r[k] for r in rows)])
        return cls(np.array([r[0] for r in rows], float).reshape(len(rows), MEASURES), np.repeat(np.arange(len(rows), dtype=np.int32), sizes), flat(1, np.int32), flat(2, np.float32))

    def take(self, rows: np.ndarray) -> Texts:
        at = np.searchsorted(self.row, rows)
        size = np.searchsorted(self.row, rows, "right") - at
        cells = np.repeat(at - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return Texts(self.measures[rows], np.repeat(np.arange(len(rows), dtype=np.int32), size), self.place[cells], self.value[cells])

    def __add__(self, other: Texts) -> Texts:
        both = lambda a, b: np.concatenate((a, b))
        return Texts(both(self.measures, other.measures), both(self.row, other.row + np.int32(len(self))), both(self.place, other.place), both(self.value, other.value))


class Words(dict):
    """Numbers of words, and by number their places (of the word, and of its start or -1) and lengths."""

    BOUND, HELD = 200_000, 1 << 24

    def __init__(self):
        super().__init__()
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.known, self.held = array("q"), 0

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.known.extend(word_places(word))
        self.known.append(len(word))
        self.held += len(word)
        return number

    def read(self, words: list[bytes]) -> np.ndarray:
        """Each word's number. Empties itself between texts, so that memory stays level."""
        if len(self) > self.BOUND or self.held > self.HELD:
            self.reset()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def word_places(word: bytes) -> tuple[int, int]:
    """Of the word without marks at its ends, and of its start (-1 where that is all of it)."""
    bare = word.lower().strip(MARKS)
    start = bare.decode("utf-8", "ignore")[:START].encode()
    return zlib.crc32(bare) % PLACES, zlib.crc32(b"^" + start) % PLACES if len(start) < len(bare) else -1


def text_row(text: str | None, known: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Measures of the writing; places of its words; steps of the logarithms of their counts."""
    out = np.zeros(MEASURES)
    raw = (text or "").encode()
    words = raw.split()
    n, size = len(words), len(raw)
    if not n:
        return out, np.empty(0, np.int64), np.empty(0, np.uint8)
    numbers = known.read(words)
    own = np.frombuffer(known.known, np.int64).reshape(-1, 3)[numbers]
    distinct = len(set(words))
    letters = size - len(raw.translate(None, b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    upper = size - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = size - len(raw.translate(None, b"0123456789"))
    marks = size - len(raw.translate(None, MARKS))
    plain = raw.count(b".") + raw.count(b",")
    wide = size - len(raw.translate(None, HIGH))
    same = int((numbers[1:] == numbers[:-1]).sum())
    lengths = own[:, 2]
    lines = raw.split(b"\n")
    out[:] = (
        np.log1p(size), np.log1p(n), lengths.mean() / 10, lengths.std() / 10, distinct / n, np.log1p(distinct) / np.log1p(n), same / n, letters / size,
        upper / size, digits / size, marks / size, (marks - plain) / size, plain / n, wide / size, words.count(b"|") / n, raw.count(b"!") / n, len(set(lines)) / len(lines), len(lines) / n,
    )
    every = own[:, :2].ravel()
    places, times = np.unique(every[every >= 0], return_counts=True)
    return out, places, np.minimum(np.round(np.log1p(times) * STEPS), 255).astype(np.uint8)


def meta_view(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """Hashed language, source and both, and the declared length."""
    out = np.zeros(META_HASHED + 4)
    for part in (f"l{lang}", f"s{source}", f"x{lang} {source}"):
        out[zlib.crc32(part.encode()) % META_HASHED] += 1
    size = np.log1p(max(0, n_chars or 0))
    out[META_HASHED:] = size / 10, size * size / 100, (n_chars is None) * 1.0, (size < 4) * 1.0
    return out


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, penalty: float = 5.0, rounds: int = 12) -> Logistic:
        """Newton's method, classes at equal weight in sum; the prior comes back in calibration."""
        mean, scale = x.mean(0), x.std(0)
        scale = np.where(scale > 1e-9, scale, 1.0)
        z = np.column_stack(((x - mean) / scale, np.ones(len(x))))
        w = np.zeros(z.shape[1])
        each = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
        ridge = np.full(z.shape[1], penalty)
        ridge[-1] = 1e-6
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            h = (z * (each * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + np.diag(ridge)
            step = np.linalg.solve(h, z.T @ (each * (y - p)) - ridge * w)
            w = w + step
            if np.abs(step).max() < 1e-6:
                break
        return cls(mean, scale, w)

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Log-odds."""
        return np.clip((x - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1], -30, 30)


def calibration(odds: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and intercept that turn a view's log-odds into the classes' own."""
    z, target = np.column_stack((odds, np.ones(len(odds)))), np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    w = np.array([0.0, np.log((y.sum() + 1) / ((1 - y).sum() + 1))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + np.diag([1e-3, 1e-6])
        w = w + np.clip(np.linalg.solve(h, z.T @ (target - p)), -2, 2)
    return (float(w[0]), float(w[1])) if w[0] > 0 else (0.0, float(np.log((y.sum() + 1) / ((1 - y).sum() + 1))))


def minimise(slope: Callable[[np.ndarray], tuple[float, np.ndarray]], w: np.ndarray, rounds: int, memory: int = 8) -> np.ndarray:
    """Limited-memory BFGS with halving steps. slope: value and gradient."""
    value, grad = slope(w)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        step, kept = -grad, []
        for s, y, r in reversed(past):
            a = r * (s @ step)
            kept.append(a)
            step = step - a * y
        if past:
            s, y, r = past[-1]
            step = step / (r * (y @ y))
        for (s, y, r), a in zip(past, reversed(kept)):
            step = step + (a - r * (y @ step)) * s
        down, size = grad @ step, 1.0 if past else 1.0 / max(1.0, float(np.abs(grad).sum()))
        if down >= 0:
            break
        while True:
            there = w + size * step
            new, new_grad = slope(there)
            if new <= value + 1e-4 * size * down or size < 1e-12:
                break
            size /= 2
        s, y = there - w, new_grad - grad
        if s @ y > 1e-12:
            past = [*past[1 - memory :], (s, y, 1.0 / (s @ y))]
        done = value - new <= 1e-7 * max(1.0, abs(value))
        w, value, grad = there, new, new_grad
        if done:
            break
    return w


@dataclass
class TextLogistic:
    """A logistic classifier of Texts."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # measures, intercept, places

    @classmethod
    def fit(cls, x: Texts, y: np.ndarray, penalty: float = 5.0, word_penalty: float = 1.0, rounds: int = 40) -> TextLogistic:
        mean, scale = x.measures.mean(0), x.measures.std(0)
        scale = np.where(scale > 1e-9, scale, 1.0)
        z = np.column_stack(((x.measures - mean) / scale, np.ones(len(x))))
        each = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
        used = np.flatnonzero(np.bincount(x.place, minlength=PLACES))
        number = np.zeros(PLACES, np.int32)
        number[used] = np.arange(len(used))
        place = number[x.place]
        ridge = np.concatenate((np.full(MEASURES, penalty), [1e-6], np.full(len(used), word_penalty)))
        k = MEASURES + 1

        def slope(w: np.ndarray) -> tuple[float, np.ndarray]:
            odds = z @ w[:k] + np.bincount(x.row, x.value * w[k:][place], len(x))
            off = 1 / (1 + np.exp(-np.clip(odds, -500, 500))) - y
            loss = (each * (np.logaddexp(0, odds) - y * odds)).sum() + 0.5 * (ridge * w * w).sum()
            off = off * each
            return float(loss), np.concatenate((z.T @ off, np.bincount(place, x.value * off[x.row], len(used)))) + ridge * w

        w = minimise(slope, np.zeros(k + len(used)), rounds)
        weights = np.zeros(k + PLACES)
        weights[:k], weights[k + used] = w[:k], w[k:]
        return cls(mean, scale, weights)

    def odds(self, x: Texts) -> np.ndarray:
        """Log-odds."""
        k = MEASURES + 1
        words = np.bincount(x.row, x.value * self.weights[k:][x.place], len(x)) if len(x) else np.zeros(0)
        return np.clip((x.measures - self.mean) / self.scale @ self.weights[: k - 1] + self.weights[k - 1] + words, -30, 30)


@dataclass
class Views:
    text: TextLogistic
    meta: Logistic
    text_scale: tuple[float, float]
    meta_scale: tuple[float, float]
    joint_scale: tuple[float, float]
    prior: float

    def odds(self, text: Texts, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated log-odds of the text view, the metadata view, and both."""
        t = self.text.odds(text) * self.text_scale[0] + self.text_scale[1]
        m = self.meta.odds(meta) * self.meta_scale[0] + self.meta_scale[1]
        return t, m, (t + m - self.prior) * self.joint_scale[0] + self.joint_scale[1]


def probability(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-odds))


@dataclass
class Judge:
    """Both views' models with their calibrations, without what they were fitted on."""

    models: tuple[TextLogistic, Logistic]
    scales: list[tuple[float, float]]

    def sure(self, text: Texts, meta: np.ndarray) -> list[np.ndarray]:
        """Each view's calibrated probability of class 1."""
        return [probability(m.odds(x) * a + b) for m, x, (a, b) in zip(self.models, (text, meta), self.scales)]


def split(text: Texts, meta: np.ndarray) -> tuple:
    """(rows, texts, metadata) of every fifth row, and of the others."""
    aside = np.arange(len(meta)) % 5 == 0
    return tuple((rows, text.take(rows), meta[rows]) for rows in (np.flatnonzero(aside), np.flatnonzero(~aside)))


def both_parts(parts: tuple) -> tuple:
    (a, x, m), (b, y, n) = parts
    return np.concatenate((a, b)), x + y, np.concatenate((m, n))


class CoTraining:
    """One target's two views over the rounds. y: 0 or 1. A fifth of the labelled rows is kept for calibration."""

    def __init__(self, parts: tuple, y: np.ndarray, share: float = 0.05):
        """parts: of split(), of the rows that y is for."""
        if any(len(set(y[rows])) < 2 for rows, _, _ in parts):
            rows, text, meta = both_parts(parts)
            parts = ((rows, text, meta), (rows, text, meta))
        self.held, self.learnt = ((text, meta, y[rows]) for rows, text, meta in parts)
        self.prior = float(np.log((y.sum() + 1) / ((1 - y).sum() + 1)))
        #: By class, how many rows a view hands on in a round at most.
        self.quota = [max(1, round(share * len(y) * part)) for part in (1 - y.mean(), y.mean())]
        self.given: list[tuple[Texts, np.ndarray] | None] = [None, None]
        self.fit()

    def fit(self) -> None:
        text, meta, y = self.learnt
        with_given = [(x, y) if g is None else (x + g[0] if k == 0 else np.concatenate((x, g[0])), np.concatenate((y, g[1]))) for k, (x, g) in enumerate(zip((text, meta), self.given))]
        self.models = TextLogistic.fit(*with_given[0]), Logistic.fit(*with_given[1])
        self.scales = [calibration(m.odds(x), self.held[2]) for m, x in zip(self.models, self.held)]

    def judge(self) -> Judge:
        return Judge(self.models, self.scales)

    def give(self, view: int, text: Texts, meta: np.ndarray, y: np.ndarray) -> None:
        """Examples for a view, from the other one."""
        x, old = (text, meta)[view], self.given[view]
        self.given[view] = (x, y) if old is None else (old[0] + x if view == 0 else np.concatenate((old[0], x)), np.concatenate((old[1], y)))

    def views(self) -> Views:
        odds = [m.odds(x) * a + b for m, x, (a, b) in zip(self.models, self.held, self.scales)]
        return Views(*self.models, *self.scales, calibration(odds[0] + odds[1] - self.prior, self.held[2]), self.prior)


def _seen(docs: DataFrame) -> list:
    return [docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang"), docs["source"].cast("string").alias("source"), docs["n_chars"].cast("long").alias("n_chars")]


def _views(batch: pa.RecordBatch, at: int, memo: Words) -> tuple[Texts, np.ndarray]:
    """Of the columns text, lang, source, n_chars from at on."""
    text = [text_row(t, memo) for t in batch.column(at).to_pylist()]
    meta = [meta_view(*x) for x in zip(*(batch.column(i).to_pylist() for i in (at + 1, at + 2, at + 3)))]
    return Texts.of([(m, p, v / STEPS) for m, p, v in text]), np.array(meta).reshape(len(meta), META)


FEATURES = "dense binary, upper binary, lower binary, steps binary"


def features(docs: DataFrame, id_column: str) -> DataFrame:
    """doc_id, FEATURES: of each row."""
    rows = docs.select(docs[id_column].alias("doc_id"), *_seen(docs))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = worker_kept("views", Words)
        for batch in text_slices(batches):
            out: list[list[bytes]] = [[], [], [], []]
            for text, lang, source, n_chars in zip(*(batch.column(i).to_pylist() for i in range(1, 5))):
                measures, places, steps = text_row(text, memo)
                dense = np.concatenate((measures, meta_view(lang, source, n_chars))).astype("<f4")
                upper = np.bincount(places >> 16, minlength=UPPER).astype("<u4")
                for column, x in zip(out, (dense, upper, (places & 0xFFFF).astype("<u2"), steps)):
                    column.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, pa.binary()) for x in out]], names=["doc_id", "dense", "upper", "lower", "steps"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {FEATURES}")


def _read(batch, at: int) -> tuple[Texts, np.ndarray]:
    """The views of rows of FEATURES, the first of which is column at."""
    dense, upper, lower, steps = (batch.column(i).to_pylist() for i in range(at, at + 4))
    n = len(dense)
    x = np.frombuffer(b"".join(dense), "<f4").reshape(n, MEASURES + META).astype(float)
    tops = np.frombuffer(b"".join(upper), "<u4").reshape(n, UPPER).astype(np.int64)
    place = np.frombuffer(b"".join(lower), "<u2").astype(np.int32) + np.repeat(np.tile(np.arange(UPPER, dtype=np.int32) << 16, n), tops.ravel())
    value = np.frombuffer(b"".join(steps), np.uint8).astype(np.float32) / np.float32(STEPS)
    return Texts(x[:, :MEASURES], np.repeat(np.arange(n, dtype=np.int32), tops.sum(1)), place, value), x[:, MEASURES:]


def fit(docs: DataFrame, labels: DataFrame, labelled: int = 8192, rounds: int = 3, share: float = 0.05, sure: float = 0.95, seed: int = 7, id_column: str = "doc_id", targets: tuple[str, ...] = TARGETS) -> dict[str, Views]:
    """By target, of those for which there are labels of both classes: the fitted views. labels: id and a column of 0 or 1 for each target."""
    targets = tuple(t for t in targets if t in labels.columns)
    at = F.xxhash64("doc_id", F.lit(seed))
    known = labels.select(labels[id_column].alias("doc_id"), *[labels[t].cast("int").alias(f"y{i}") for i, t in enumerate(targets)]).where("doc_id is not null")
    known = known.groupBy("doc_id").agg(*[F.max(f"y{i}").alias(f"y{i}") for i in range(len(targets))])
    if targets:
        known = known.where(F.coalesce(*[F.col(f"y{i}") for i in range(len(targets))]).isNotNull())
    ids = docs.select(docs[id_column].alias("doc_id")).where("doc_id is not null").distinct()
    chosen = known.join(ids, "doc_id", "left_semi").orderBy(at, "doc_id").limit(labelled)
    rows = stored(features(docs, id_column).withColumn("row", F.monotonically_increasing_id()))
    got = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", *[f"y{i}" for i in range(len(targets))]).agg(F.max(F.struct("dense", "upper", "lower", "steps")).alias("x"))
    got = got.select("doc_id", "x.*", *[f"y{i}" for i in range(len(targets))]).orderBy(at, "doc_id").toArrow()
    if not got.num_rows:
        return {}
    text, meta = _read(got, 1)
    training, parts = {}, split(text, meta)
    for i, t in enumerate(targets):
        y = np.array([-1 if v is None else int(v > 0) for v in got[f"y{i}"].to_pylist()], float)
        if (y == 1).any() and (y == 0).any():
            some = np.flatnonzero(y >= 0)
            # where all rows have all labels, targets share the rows' features
            training[t] = CoTraining(parts if len(some) == len(y) else split(text.take(some), meta[some]), y[some], share)
    if not training:
        return {}
    spark, names = docs.sparkSession, list(training)
    sample = frozenset(got["doc_id"].to_pylist())
    del got, text, meta, parts
    handed = [set() for _ in range(2 * len(names))]  # rows by the view that has them
    for _ in range(rounds):
        state = spark.sparkContext.broadcast((sample, handed, [training[t].judge() for t in names]))

        def ask(batches: Iterable[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            sample, handed, models = state.value
            for batch in slices(batches):
                text, meta = _read(batch, 2)
                ids, numbers = batch.column(1).to_pylist(), batch.column(0).to_numpy()
                free = np.array([i not in sample for i in ids], bool)
                found = []
                for t, model in enumerate(models):
                    for view, p in enumerate(model.sure(text, meta)):
                        theirs = handed[2 * t + 1 - view]
                        new = free & np.array([r not in theirs for r in numbers.tolist()], bool) if theirs else free
                        for label, certainty in ((0, 1 - p), (1, p)):
                            some = np.flatnonzero(new & (certainty >= sure))
                            found.append((numbers[some], np.full(len(some), 4 * t + 2 * view + label, np.int32), np.round(certainty[some], 6)))
                row, part, certainty = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(part), pa.array(certainty)], names=["row", "part", "certainty"])

        asked = rows.select("row", "doc_id", "dense", "upper", "lower", "steps").mapInArrow(ask, "row long, part int, certainty double")
        most = F.coalesce(*[F.when(F.col("part") == 4 * t + 2 * view + label, training[n].quota[label]) for t, n in enumerate(names) for view in (0, 1) for label in (0, 1)])
        turn = F.row_number().over(Window.partitionBy("part").orderBy(F.desc("certainty"), F.xxhash64("row", F.lit(seed)), "row"))
        most_of_all = max(max(training[n].quota) for n in names)
        best = stored(asked.withColumn("turn", turn).where(F.col("turn") <= most_of_all).where(F.col("turn") <= most).select("row", "part"))
        new = rows.join(F.broadcast(best), "row").select("row", "part", "dense", "upper", "lower", "steps").orderBy("part", "row").toArrow()
        text, meta = _read(new, 2)
        row, part = new["row"].to_numpy(), new["part"].to_numpy()
        for t, n in enumerate(names):
            for view in (0, 1):
                some = np.flatnonzero(part // 2 == 2 * t + view)
                if len(some):
                    training[n].give(1 - view, text.take(some), meta[some], (part[some] % 2).astype(float))
                    handed[2 * t + 1 - view] |= set(row[some].tolist())
            training[n].fit()
        state.unpersist()
        if not new.num_rows:
            break
    return {t: x.views() for t, x in training.items()}


def score(docs: DataFrame, models: dict[str, Views], threshold: float = 0.5, toxic_threshold: float = 0.3) -> DataFrame:
    """doc (a struct of docs' columns), text_score, meta_score, quality_score (probabilities of good quality), toxic_score (that the text is toxic), keep (quality_score is at least threshold, and toxic_score less than toxic_threshold, as far as they are known)."""
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"), *_seen(docs))
    names = ("text_score", "meta_score", "quality_score", "toxic_score")
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, models = worker_kept("views", Words), sent.value
        for batch in text_slices(batches):
            views = _views(batch, 1, memo)
            found = {t: [probability(odds) for odds in m.odds(*views)] for t, m in models.items()}
            keep = np.ones(batch.num_rows, bool)
            if "quality" in found:
                keep &= found["quality"][2] >= threshold
            if "toxic" in found:
                keep &= found["toxic"][2] < toxic_threshold
            none = pa.nulls(batch.num_rows, pa.float64())
            scores = [*(map(pa.array, found["quality"]) if "quality" in found else [none] * 3), pa.array(found["toxic"][2]) if "toxic" in found else none]
            yield pa.RecordBatch.from_arrays([batch.column(0), *scores, pa.array(keep)], names=["doc", *names, "keep"])

    schema = T.StructType([rows.schema["doc"], *[T.StructField(c, T.DoubleType()) for c in names], T.StructField("keep", T.BooleanType())])
    return rows.mapInArrow(run, schema)
