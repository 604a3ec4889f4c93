"""Greedy word-piece lengths by a longest-match automaton.

The vocabulary is a trie. Where no edge fits the next character, a failure link
leads to the node for what remains of the match after its longest pieces are
popped, and a number stored with the link says how many pieces those are. Each
character is thus read once, nothing is looked at again, and no piece is built.

Defined results: a null or empty text has no words and no tokens. Words are runs
of characters that str.split() doesn't take for white space, and are spelt with the
mark before them; the mark alone may be a piece, and counts as one. A word that the
vocabulary can't spell counts as one unknown token. Words of any length are read
whole. Every row gives a row: ids may repeat or be null, and further columns, whatever their names, take no part.
An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Memo, slices

UNKNOWN = -1


class LongestMatch:
    """word_starts and continuations: the pieces that may begin a word, and those that may follow. An empty start is the mark alone: where no other start fits, it is popped and continuations follow."""

    def __init__(self, word_starts: Iterable[str], continuations: Iterable[str]):
        self.edges: list[dict[str, int]] = [{}, {}]
        self.first, self.later = 0, 1
        word_starts = set(word_starts)
        self.lone_mark = "" in word_starts
        ends = [self._insert(self.first, p) for p in word_starts if p] + [self._insert(self.later, p) for p in continuations if p]
        self._link(set(ends))

    def _insert(self, node: int, piece: str) -> int:
        for c in piece:
            nxt = self.edges[node].get(c)
            if nxt is None:
                nxt = self.edges[node][c] = len(self.edges)
                self.edges.append({})
            node = nxt
        return node

    def _link(self, ends: set[int]) -> None:
        """Failure links (UNKNOWN: there is none) and the pieces popped along them, by breadth."""
        n = len(self.edges)
        self.fail, self.popped = [UNKNOWN] * n, [0] * n
        if self.lone_mark:
            self.fail[self.first], self.popped[self.first] = self.later, 1
        level = [self.first, self.later]
        while level:
            below = []
            for node in level:
                for c, child in self.edges[node].items():
                    below.append(child)
                    if child in ends:
                        self.fail[child], self.popped[child] = self.later, 1
                        continue
                    popped, at = self.popped[node], self.fail[node]
                    while at != UNKNOWN and c not in self.edges[at]:
                        popped += self.popped[at]
                        at = self.fail[at]
                    if at != UNKNOWN:
                        self.fail[child], self.popped[child] = self.edges[at][c], popped
            level = below
        # what is popped if the word ends here
        self.last = [UNKNOWN] * n
        self.last[self.later] = 0
        for node in range(n):
            path = []
            while node != UNKNOWN and self.last[node] == UNKNOWN:
                path.append(node)
                node = self.fail[node]
            if node != UNKNOWN:
                total = self.last[node]
                for x in reversed(path):
                    total += self.popped[x]
                    self.last[x] = total

    def count(self, word: str) -> int:
        """Pieces of the greedy longest match; UNKNOWN if there is none."""
        edges, fail, popped = self.edges, self.fail, self.popped
        node, total = self.first, 0
        for c in word:
            nxt = edges[node].get(c)
            while nxt is None:
                total += popped[node]
                node = fail[node]
                if node == UNKNOWN:
                    return UNKNOWN
                nxt = edges[node].get(c)
            node = nxt
        return UNKNOWN if self.last[node] == UNKNOWN else total + self.last[node]


def piece_vocabulary(model_path: str) -> tuple[list[str], list[str]]:
    """Word starts (without their mark, "" for the mark alone) and continuations of a sentencepiece model's ordinary pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    mark = "▁"
    return [p[1:] for p in pieces if p[0] == mark], pieces


@lru_cache(maxsize=1)
def automaton_of(model_path: str) -> LongestMatch:
    """One for each Python worker, for its tasks one after another."""
    return LongestMatch(*piece_vocabulary(model_path))


def count_tokens(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_words, n_tokens (unknown words count one each), n_unknown."""
    kept = docs.select(docs[id_column].alias(id_column), docs[text_column].cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = automaton_of(model_path)
        memo = Memo(automaton.count)
        for batch in slices(batches):
            words, tokens, unknown = [], [], []
            for text in batch.column(1).to_pylist():
                counts = [memo[w] for w in (text or "").split()]
                missing = counts.count(UNKNOWN)
                words.append(len(counts))
                tokens.append(sum(counts) + 2 * missing)
                unknown.append(missing)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64()), pa.array(unknown, pa.int64())], names=[id_column, "n_words", "n_tokens", "n_unknown"])

    return kept.mapInArrow(run, f"`{id_column}` {kept.schema[0].dataType.simpleString()}, n_words long, n_tokens long, n_unknown long")
