"""Byte-level BPE by a sentencepiece model that is written straight from the ranks.

Each byte stands for one printable character, so each vocabulary entry becomes a
piece of such characters, scored by its negative rank; sentencepiece then merges
in the order of the ranks. The model's normaliser is the identity. Every match of
the pre-token pattern is encoded by itself, and ids are decoded by the inverse of
the mapping.

Defined results: a null or empty text has no ids and decodes to nothing. Strings
that look like special tokens are ordinary text. Every row gives a row: ids may repeat or be null, and further columns,
whatever their names, take no part. An empty table gives an empty one.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Memo, slices


def byte_characters() -> list[str]:
    """By byte: itself if it prints in Latin-1, else the next unused character from U+0100 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b if b in prints else next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def model_proto(ranks: dict[bytes, int]) -> tuple[bytes, list[int]]:
    """A serialised model, and the rank of each of its ids (the first, unknown, has none)."""
    characters = byte_characters()
    normal, unknown, bpe = 1, 2, 2
    order = sorted(ranks, key=ranks.get)

    def piece(text: str, score: float, kind: int) -> bytes:
        return _block(1, _block(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))

    pieces = [piece("<unk>", 0.0, unknown)]
    pieces += [piece("".join(characters[b] for b in token), -float(ranks[token]), normal) for token in order]
    trainer = _block(2, _number(3, bpe))
    normaliser = _block(3, _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0))
    return b"".join(pieces) + trainer + normaliser, [-1, *(ranks[t] for t in order)]


class ByteBPE:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        import sentencepiece

        proto, self.rank_of = model_proto(ranks)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.find = regex.compile(pattern).findall
        self.table = dict(enumerate(byte_characters()))
        # a pre-token that is in the vocabulary is its own id; this holds the entries (of usual vocabularies none) that the merges don't reach
        entries = list(ranks)
        spelt = self.model.encode([self._characters(token) for token in entries])
        self.unreached = {token: ranks[token] for token, ids in zip(entries, spelt) if [self.rank_of[i] for i in ids] != [ranks[token]]}

    def _characters(self, raw: bytes) -> str:
        return raw.decode("latin-1").translate(self.table)

    def encode_piece(self, piece: str) -> list[int]:
        """The ids of one pre-token."""
        raw, rank_of = piece.encode("utf-8", "surrogatepass"), self.rank_of
        if raw in self.unreached:
            return [self.unreached[raw]]
        return [rank_of[i] for i in self.model.encode(self._characters(raw))]

    def encode(self, text: str) -> list[int]:
        return [i for piece in self.find(text) for i in self.encode_piece(piece)]

    def decode(self, ids: Iterable[int]) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])


@lru_cache(maxsize=1)
def _worker(ranks_path: str, pattern: str) -> ByteBPE:
    """One for each Python worker, for its tasks one after another."""
    return ByteBPE(read_ranks(ranks_path), pattern)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, ids (array of the tokens' ranks)."""
    kept = docs.select(docs[id_column].alias(id_column), docs[text_column].cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _worker(ranks_path, pattern)
        memo = Memo(bpe.encode_piece)
        for batch in slices(batches, 128):
            ids = [[i for p in bpe.find(text or "") for i in memo[p]] for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[id_column, "ids"])

    return kept.mapInArrow(run, f"`{id_column}` {kept.schema[0].dataType.simpleString()}, ids array<int>")


def decode_documents(encoded: DataFrame, ranks_path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """id, decoded (the bytes that the ids stand for)."""
    kept = encoded.select(encoded[id_column].alias(id_column), encoded[ids_column].alias("ids"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in read_ranks(ranks_path).items()}
        for batch in slices(batches, 128):
            raw = [b"".join([tokens[i] for i in ids or ()]) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=[id_column, "decoded"])

    return kept.mapInArrow(run, f"`{id_column}` {kept.schema[0].dataType.simpleString()}, decoded binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256 (of the decimal ids, joined by a space), decoded_sha256: encoding, then decoding, in one pass; each distinct pre-token is encoded and decoded once."""
    kept = docs.select(docs[id_column].alias(id_column), docs[text_column].cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _worker(ranks_path, pattern)

        def both(piece: str) -> tuple[str, int, bytes]:
            ids = bpe.encode_piece(piece)
            return " ".join(map(str, ids)), len(ids), bpe.decode(ids)

        memo = Memo(both, 300_000)
        for batch in slices(batches, 128):
            counts, encoded, decoded = [], [], []
            for text in batch.column(1).to_pylist():
                found = [memo[p] for p in bpe.find(text or "")]
                counts.append(sum([x[1] for x in found]))
                encoded.append(hashlib.sha256(" ".join([x[0] for x in found]).encode()).hexdigest())
                decoded.append(hashlib.sha256(b"".join([x[2] for x in found])).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())], names=[id_column, "n_tokens", "ids_sha256", "decoded_sha256"])

    return kept.mapInArrow(run, f"`{id_column}` {kept.schema[0].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
