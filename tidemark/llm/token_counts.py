"""Word-piece counts by a linear longest-match automaton.

The vocabulary is a trie. Where a word leaves the trie, its longest-match pieces
so far are known in advance: the failure link of a node leads to the node of
what is left after popping them, and the node holds how many were popped. So a
word takes one pass and its pieces are never built.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable
from functools import cache

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map

VOCABULARY = "piece_bpe_32k.model"
# Fixed value: the mark of a word's first piece.
MARK = "▁"
# Words of a task's cache; a full cache starts anew.
CACHE = 1 << 19


def pieces(path: str) -> list[str]:
    """The vocabulary's pieces, without control, unknown and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    skip = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
    return [model.id_to_piece(i) for i in ids if not skip(i)]


class Automaton:
    """Counts the greedy longest-match pieces of words.

    A code point that no piece starts with counts as its UTF-8 bytes, for which
    the vocabulary has pieces. Code points inside pieces get that count as
    pieces of their own, so that a match can fail only where one is unknown.
    """

    def __init__(self, vocabulary: Iterable[str]):
        counts = {p: 1 for p in vocabulary if p}
        for point in {c for p in counts for c in p}:
            counts.setdefault(point, len(point.encode("utf-8", "surrogatepass")))
        self.next: list[dict[str, int]] = [{}]
        own: list[int] = [0]
        for piece, count in counts.items():
            node = 0
            for c in piece:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    own.append(0)
                node = self.next[node][c]
            own[node] = count
        self.fail, self.popped = [-1] * len(own), [0] * len(own)
        # Shorter strings first: a link leads to a shorter string.
        queue = deque([0])
        while queue:
            up = queue.popleft()
            for c, node in self.next[up].items():
                if own[node]:
                    self.fail[node], self.popped[node] = 0, own[node]
                else:
                    at, popped = self.fail[up], self.popped[up]
                    while c not in self.next[at]:
                        popped += self.popped[at]
                        at = self.fail[at]
                    self.fail[node], self.popped[node] = self.next[at][c], popped
                queue.append(node)

    def count(self, word: str) -> int:
        step, fail, popped = self.next, self.fail, self.popped
        node = total = 0
        for c in word:
            while c not in step[node]:
                if not node:
                    total += len(c.encode("utf-8", "surrogatepass"))
                    break
                total += popped[node]
                node = fail[node]
            else:
                node = step[node][c]
        while node:
            total += popped[node]
            node = fail[node]
        return total


class WordCounts(dict):
    """Counts by word; what it holds only decides what is counted anew."""

    def __init__(self, automaton: Automaton, size: int = CACHE):
        super().__init__()
        self.automaton, self.size = automaton, size

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.size:
            self.clear()
        count = self.automaton.count(MARK + word.decode("utf-8"))
        if len(word) <= 64:
            self[word] = count
        return count


@cache
def counter(path: str) -> WordCounts:
    return WordCounts(Automaton(pieces(path)))


def token_counts(
    df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None
) -> DataFrame:
    """One row per input row: key, n_words, n_tokens.

    Words are runs other than ASCII white space; each starts with the mark of a
    first piece. n_tokens is the number of its pieces when the longest one that
    fits is taken again and again. Null and empty texts have none. Repeated rows
    are counted each, null keys are kept, other columns are ignored; an empty
    table gives no rows.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    kind = df.schema[key].dataType.simpleString()

    def work(batches):
        count = counter(path).__getitem__
        for batch in batches:
            words, tokens = [], []
            for text in batch.column(1).to_pylist():
                found = (text or "").encode("utf-8").split()
                words.append(len(found))
                tokens.append(sum(map(count, found)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                names=[key, "n_words", "n_tokens"],
            )

    small = df.select(F.col(key), F.col(text).cast("string").alias("_text"))
    return arrow_map(small, work, f"`{key}` {kind}, n_words bigint, n_tokens bigint")
