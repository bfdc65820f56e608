"""Token counts by a linear longest-match automaton.

A word is cut greedily from the left into the longest pieces of a vocabulary in which a mark tells pieces that begin a
word; bytes that no piece covers count one each. The vocabulary is a trie of bytes. Each node that is not itself a whole
match has a failure link - where matching goes on once the pieces that are settled by then are taken off - and the number of
those pieces, both worked out beforehand, so a word of n bytes takes at most 2 n steps, never goes back, and no piece is built.

Words are runs of bytes other than blanks (space and 9 to 13). A worker keeps the counts of words it has met of late. Null
and empty texts have no words and no tokens; repeated rows are counted each on its own; no rows, no rows.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Sequence
from functools import lru_cache

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from foliary.llm.frames import map_text

#: Words in each of the two generations of a worker's memory, and the bytes of the longest that it keeps.
MEMO_WORDS, MEMO_BYTES = 300_000, 64


class Automaton:
    """count(word bytes): the pieces of the greedy longest match."""

    def __init__(self, pieces: Iterable[bytes], mark: bytes) -> None:
        """pieces: those that begin a word start with the mark; the mark alone and single bytes are always pieces."""
        step: dict[int, int] = {}
        whole, nodes = {0: False}, 1
        edges: list[list[tuple[int, int]]] = [[]]
        for piece in {*pieces, mark, *(bytes([b]) for b in range(256))}:
            at = 0
            for b in piece:
                key = at << 8 | b
                if key not in step:
                    step[key] = nodes
                    edges[at].append((b, nodes))
                    edges.append([])
                    whole[nodes] = False
                    nodes += 1
                at = step[key]
            whole[at] = True
        link, popped = [0] * nodes, [0] * nodes
        queue = deque([0])
        while queue:
            v = queue.popleft()
            for b, u in edges[v]:
                queue.append(u)
                if whole[u]:  # taken off as one piece, then the root
                    popped[u] = 1
                    continue
                z, n = link[v], popped[v]
                while (to := step.get(z << 8 | b)) is None:
                    n += popped[z]
                    z = link[z]
                link[u], popped[u] = to, n
        self.step, self.link, self.popped = step, link, popped
        self.start = 0
        for b in mark:
            self.start = step[self.start << 8 | b]

    def count(self, word: bytes) -> int:
        step, link, popped, at, n = self.step, self.link, self.popped, self.start, 0
        for b in word:
            while (to := step.get(at << 8 | b)) is None:
                n += popped[at]
                at = link[at]
            at = to
        while at:
            n += popped[at]
            at = link[at]
        return n


@lru_cache(2)
def automaton(path: str) -> Automaton:
    """For the pieces of a sentencepiece model; its byte tokens are single bytes, its control tokens no pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return Automaton((model.id_to_piece(i).encode() for i in ids), "▁".encode())


class Counter:
    """count(text bytes) -> (words, tokens)."""

    def __init__(self, path: str) -> None:
        self.automaton = automaton(path)
        self.memo: dict[bytes, int] = {}
        self.older: dict[bytes, int] = {}

    def count(self, text: bytes) -> tuple[int, int]:
        words = text.split()
        try:
            return len(words), sum(map(self.memo.__getitem__, words))
        except KeyError:
            pass
        if len(self.memo) > MEMO_WORDS:
            self.memo, self.older = {}, self.memo
        long: dict[bytes, int] = {}
        for w in set(words):
            if w not in self.memo:
                (self.memo if len(w) <= MEMO_BYTES else long)[w] = self.older.get(w) or self.automaton.count(w)
        return len(words), sum(long[w] if len(w) > MEMO_BYTES else self.memo[w] for w in words)


def count_tokens(documents: DataFrame, model: str, *, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Columns `keep`, n_words and n_tokens of every whole text."""

    def make():
        counter = Counter(model)

        def kernel(texts):
            found = [counter.count(t.as_py()) for t in texts]
            return [pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)]

        return kernel

    return map_text(documents, make, [("n_words", "bigint"), ("n_tokens", "bigint")], text=text, keep=keep)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
