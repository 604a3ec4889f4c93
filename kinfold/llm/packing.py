"""Packing documents into training sequences of balanced attention cost.

A sequence's cost is estimated as linear * tokens + quadratic * (sum of its
pieces' squared lengths), for attention stays within a document. Documents longer
than `longest` are cut into equal pieces of at most that length first, so that no sequence's cost is one long piece's. Pieces are
collected until `group` sequences can be filled; then, in descending order, each goes to
the sequence of lowest cost that has room for it. A piece for which no sequence
has room is cut along the room that the cheapest ones have. So every sequence of
a group is full, and only what a partition has left at its end is shorter: it is
cut into lengths that are powers of two, which need no padding. The order is descending within a group (what that loses against
the whole table's is in the README); what a group has no room for, the last that came, waits for the next.

Defined results: a null or empty text is its end token alone. Ties go to the
earlier sequence. Sequence ids are unique over partitions. Every row is packed, as often as it comes, with equal or null ids
too. An empty table gives no pieces. Further columns, whatever their names, take no part.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import Memo, slices, worker_kept

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def balance(pieces: list[tuple], sequences: int, capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, tuple, int, int]]:
    """pieces: (length, ...), in all sequences * capacity long. (sequence, offset, piece, from, length) of each part."""
    room, cost = [capacity] * sequences, [0.0] * sequences
    heap = [(0.0, s) for s in range(sequences)]
    out = []

    def put(s: int, piece: tuple, start: int, length: int) -> None:
        out.append((s, capacity - room[s], piece, start, length))
        room[s] -= length
        cost[s] += linear * length + quadratic * length * length
        if room[s]:
            heapq.heappush(heap, (cost[s], s))

    for piece in sorted(pieces, key=lambda p: -p[0]):
        length, passed = piece[0], []
        while heap and room[heap[0][1]] < length:
            passed.append(heapq.heappop(heap))
        if heap:
            put(heapq.heappop(heap)[1], piece, 0, length)
            for x in passed:
                heapq.heappush(heap, x)
            continue
        start = 0
        for k, (_, s) in enumerate(passed):
            take = min(room[s], length - start)
            put(s, piece, start, take)
            start += take
            if start == length:
                for x in passed[k + 1 :]:
                    heapq.heappush(heap, x)
                break
    return out


def powers(total: int, capacity: int) -> list[int]:
    """Descending lengths, capacity or powers of two, that sum to total."""
    out = [capacity] * (total // capacity)
    rest = total % capacity
    return out + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


class _Writer:
    def __init__(self, partition: int):
        self.next, self.rows = partition << 33, []

    def add(self, sequence: int, offset: int, doc, start: int, ids: np.ndarray, whole: int) -> None:
        self.rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4", copy=False).tobytes()), whole, sequence, offset))

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * 7
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[x.split()[0] for x in SCHEMA.split(", ")])


def pack_ids(rows: Iterable[tuple[int, np.ndarray]], partition: int, capacity: int = 4096, group: int = 256, longest: int | None = None, linear: float = 1.0, quadratic: float = 1 / 4096) -> Iterator[pa.RecordBatch]:
    """rows: a document's id and its token ids; SCHEMA's rows, in batches. Holds a group's tokens at most, and one document's. longest: half of capacity, if none is given."""
    longest = min(longest or max(1, capacity // 2), capacity)
    out = _Writer(partition)
    waiting: list[tuple] = []  # (length, doc, start, ids, whole)
    held = 0

    def flush(sequences: int) -> None:
        """Fills as many whole sequences; what is over, a cut of the last pieces, waits on."""
        nonlocal waiting, held
        over, spare = held - sequences * capacity, []
        while over:
            length, doc, start, ids, whole = waiting.pop()
            if length <= over:
                spare.append((length, doc, start, ids, whole))
                over -= length
            else:
                keep = length - over
                waiting.append((keep, doc, start, ids[:keep], whole))
                spare.append((over, doc, start + keep, ids[keep:], whole))
                over = 0
        for s, offset, (_, doc, start, ids, whole), a, n in balance(waiting, sequences, capacity, linear, quadratic):
            out.add(out.next + s, offset, doc, start + a, ids[a : a + n], whole)
        out.next += sequences
        waiting = spare[::-1]
        held = sum(p[0] for p in waiting)

    for doc, ids in rows:
        whole, n = len(ids), -(-len(ids) // longest)
        for k in range(n):
            start, end = whole * k // n, whole * (k + 1) // n
            waiting.append((end - start, doc, start, ids[start:end].copy() if n > 1 else ids, whole))
            held += end - start
            if held >= group * capacity:
                flush(held // capacity)
        if len(out.rows) >= 4096:
            yield out.take()
    if held >= capacity:
        flush(held // capacity)
    lengths = powers(held, capacity)
    pieces = sorted(waiting, key=lambda p: -p[0])
    for length in lengths:
        offset = 0
        while offset < length:
            n, doc, start, ids, whole = pieces[0]
            take = min(n, length - offset)
            out.add(out.next, offset, doc, start, ids[:take], whole)
            offset += take
            if take == n:
                pieces.pop(0)
            else:
                pieces[0] = (n - take, doc, start + take, ids[take:], whole)
        out.next += 1
    yield out.take()


class WordTokenizer:
    """Ids of whole texts from a tokenizers file whose pre-tokens never reach over white space: each distinct word is encoded once.

    Words are parted at ASCII white space, which every pattern's \\s has; what is left in a word of other white space is the tokenizer's business. A new word of Latin letters only (below U+0250, where lower-casing and letter classes are alike in all libraries) is parted once more, by the file's own pattern, so that case and punctuation don't make more words to encode. Files of another make are used on whole texts.
    """

    LATIN = "ɐ"

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        normalisers = [(n["type"], n.get("pattern"), n.get("content")) for n in (made.get("normalizer") or {}).get("normalizers", ())]
        split = ((made.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        self.by_word = normalisers == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)] and split.get("type") == "Split" and split.get("behavior") == "Removed" and bool(split.get("invert")) and not made.get("post_processor")
        self.parts = regex.compile(split["pattern"]["Regex"]).findall if self.by_word else None
        self.part = Memo(self._encode, 1_000_000)
        self.word = Memo(self._word, 300_000)

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def _word(self, raw: bytes) -> bytes:
        word, part = raw.decode(), self.part
        if not word.isascii() and max(word) >= self.LATIN:
            return self._encode(word)
        stem = word.rstrip(MARKS)
        if stem.isalpha():  # one run of letters, one of marks
            return part[stem.lower()] + part[word[len(stem) :]] if len(stem) < len(word) else part[stem.lower()]
        return b"".join([part[p] for p in self.parts(word.lower())])

    def encode(self, text: str) -> np.ndarray:
        if not self.by_word:
            return np.frombuffer(self._encode(text), np.uint32)
        word = self.word
        return np.frombuffer(b"".join([word[w] for w in text.encode().split()]), np.uint32)


#: ASCII characters that are neither letters, digits nor white space.
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())


def word_tokenizer(path: str) -> WordTokenizer:
    """One for each Python worker, for its tasks one after another."""
    return worker_kept(("words", path), lambda: WordTokenizer(path))


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 4096, group: int = 256, longest: int | None = None, linear: float = 1.0, quadratic: float = 1 / 4096, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """SCHEMA's row for each piece of each document; a document is its tokens and end_id."""
    texts = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokenizer(tokenizer_path)

        def rows() -> Iterator[tuple[int, np.ndarray]]:
            for batch in slices(batches, 128):
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    yield doc, np.append(words.encode(text or ""), np.uint32(end_id))

        yield from pack_ids(rows(), TaskContext.get().partitionId(), capacity, group, longest, linear, quadratic)

    return texts.mapInArrow(run, SCHEMA)
