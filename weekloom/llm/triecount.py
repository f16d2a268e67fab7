"""Token counts under a unigram model, by dynamic programming shared in a trie.

A text's pre-tokens are its words with the word mark in front. The token sequence of a
pre-token is the cut into pieces of greatest summed score; bytes that no piece covers cost a
fallback token each. Of equal scores the one with fewer tokens counts.

Distinct pre-tokens of an input piece are put into a trie. The forward score of a node (best
score of the prefix it spells) is computed once for all pre-tokens that share it, one depth
at a time for all nodes of that depth: each node hands its children the pieces begun on its
path, as states in the trie of the pieces. A pre-token's end stores its count; a document's
count is the sum over its words. Everything stays in the task that read the text, so there is
no shuffle, and a task holds one piece of input.

Pre-tokens beyond ``LONG`` bytes share next to nothing; they run through the same recurrence
alone, with memory for the longest piece only.

NULL and empty texts have no tokens. Rows come back as they are, with two columns more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from .text import pieces, raw_texts

MARK = "▁".encode()
LONG = 64
INPUT_BYTES = 8 << 20
# A value holds a score and, below it, minus the number of tokens, so that sums keep both. It
# holds pre-tokens of up to ``LONG`` bytes; longer ones keep the two apart.
SHIFT = 24


class Pieces:
    """Trie of the pieces, as sorted transitions (state, byte) -> state; state 0 is the root."""

    def __init__(self, scores: dict[bytes, int]) -> None:
        """``scores``: whole numbers; use scaled ones if a model's are fractions."""
        self.fallback = (min(scores.values(), default=0) - 1 << SHIFT) - 1
        self.scores = {p: s for p, s in scores.items() if p}
        self.values = {p: (s << SHIFT) - 1 for p, s in self.scores.items()}
        self.longest = max(map(len, self.values), default=1)
        states, edges, ends = {b"": 0}, [], [None]
        for piece in sorted(self.values):
            for n in range(1, len(piece) + 1):
                if piece[:n] not in states:
                    states[piece[:n]] = len(ends)
                    edges.append((states[piece[: n - 1]] << 8 | piece[n - 1], len(ends)))
                    ends.append(self.values.get(piece[:n]))
        edges.sort()
        self.keys = np.array([k for k, _ in edges] or [-1], np.int64)
        self.to = np.array([s for _, s in edges] or [0], np.int64)
        self.is_end = np.array([e is not None for e in ends])
        self.value = np.array([e or 0 for e in ends], np.int64)

    def step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Next states, -1 where no piece goes on like that."""
        key = state << 8 | byte
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], -1)


def tokens_of(value):
    """Number of tokens in a forward value."""
    return -value & (1 << SHIFT) - 1


def alone(word: bytes, model: Pieces) -> int:
    """Token count of one pre-token, keeping as many forward values as a piece has bytes.

    Score and count are kept apart here: a long pre-token may have more tokens than ``SHIFT`` bits.
    """
    known = [(0, 0)]
    fallback = model.fallback + 1 >> SHIFT
    for end in range(1, len(word) + 1):
        value = (known[-1][0] + fallback, known[-1][1] - 1)
        for size in range(1, min(model.longest, end) + 1):
            piece = model.scores.get(word[end - size : end])
            if piece is not None:
                value = max(value, (known[-size][0] + piece, known[-size][1] - 1))
        known.append(value)
        if len(known) > model.longest:
            del known[0]
    return -known[-1][1]


def counts(words: list[bytes], model: Pieces) -> np.ndarray:
    """Token counts of distinct words (their pre-tokens start with the mark)."""
    out = np.zeros(len(words), np.int64)
    marked = [MARK + w for w in words]
    for i, w in enumerate(marked):
        if len(w) > LONG:
            out[i] = alone(w, model)
    order = sorted((i for i, w in enumerate(marked) if len(w) <= LONG), key=marked.__getitem__)
    if not order:
        return out
    where = np.array(order)
    sizes = np.array([len(marked[i]) for i in order])
    text = np.frombuffer(b"".join(marked[i] for i in order), np.uint8).astype(np.int64)
    start = np.cumsum(sizes) - sizes
    live = np.arange(len(order))
    node = np.zeros(len(order), np.int64)  # node of each live word at the depth reached
    forward = np.zeros(1, np.int64)
    # Pieces begun on the path to each node: state and the forward value where they began.
    state, began, first = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(2, np.int64)
    for depth in range(int(sizes.max())):
        byte = text[start[live] + depth]
        new = np.ones(len(live), bool)
        new[1:] = (node[1:] != node[:-1]) | (byte[1:] != byte[:-1])
        parent, letter = node[new], byte[new]
        node = np.cumsum(new) - 1
        # Each new node takes over its parent's pieces and begins one of its own.
        n = first[parent + 1] - first[parent]
        own = np.repeat(np.arange(len(parent)), n)
        take = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[parent], n)
        own = np.concatenate([own, np.arange(len(parent))])
        moved = model.step(np.concatenate([state[take], np.zeros(len(parent), np.int64)]), letter[own])
        since = np.concatenate([began[take], forward[parent]])
        value = forward[parent] + model.fallback
        done = (moved >= 0) & model.is_end[moved]
        np.maximum.at(value, own[done], since[done] + model.value[moved[done]])
        going = moved >= 0
        own, state, began = own[going], moved[going], since[going]
        order_ = np.argsort(own, kind="stable")
        state, began = state[order_], began[order_]
        first = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=len(parent)))])
        forward = value
        ended = sizes[live] == depth + 1
        out[where[live[ended]]] = tokens_of(forward[node[ended]])
        live, node = live[~ended], node[~ended]
    return out


def count_tokens(docs: DataFrame, scores: dict[bytes, int]) -> DataFrame:
    """Every row with n_words and n_tokens (input columns so named give way). ``scores`` are sent to all tasks: a vocabulary."""
    docs = docs.drop("n_words", "n_tokens")
    sent = docs.sparkSession.sparkContext.broadcast(scores)
    columns = docs.columns

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Pieces(sent.value)
        for batch in pieces(batches, limit=INPUT_BYTES):
            known: dict[bytes, int] = {}
            texts = [t.split() for t in raw_texts(batch)]
            number = np.fromiter((known.setdefault(w, len(known)) for t in texts for w in t), np.int64)
            n = np.fromiter(map(len, texts), np.int64, len(texts))
            each = counts(list(known), model)[number] if len(number) else np.zeros(0, np.int64)
            ends = np.concatenate([[0], np.cumsum(each)])[np.concatenate([[0], np.cumsum(n)])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(n), pa.array(np.diff(ends))],
                names=[*columns, "n_words", "n_tokens"],
            )

    schema = StructType(list(docs.schema.fields)).add("n_words", LongType()).add("n_tokens", LongType())
    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(rows, schema)


def piece_scores(path: str) -> dict[bytes, int]:
    """Pieces and whole-number scores of a sentencepiece model file; control and byte pieces left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return {
        model.id_to_piece(i).encode(): round(model.get_score(i))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    }
