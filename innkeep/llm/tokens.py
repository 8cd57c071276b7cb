"""Token counts by a linear longest-match automaton."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from innkeep.llm.common import arrow_map, batches, sliced, texts

MEMO_WORDS = 500_000
MEMO_BYTES = 64
SPACE = "▁".encode()  # begins a word in the vocabulary

_ROWS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
_AUTOMATA: dict[str, "Automaton"] = {}


class Automaton:
    """A trie of the pieces with failure links.

    ``pops[v]`` is the number of pieces that greedy longest match takes from the
    front of v's string before what is left is ``fail[v]``'s string. A byte that v
    has no child for pops that many and goes on from ``fail[v]``; so each byte is
    read once, and no piece is ever built. Every byte is a piece (what is in no other
    piece costs one token a byte), so there is always a way on.
    """

    def __init__(self, pieces: Iterable[bytes]) -> None:
        whole = {*pieces, *(bytes([b]) for b in range(256))} - {b""}
        self.child: list[dict[int, int]] = [{}]
        final = [False]
        for piece in whole:
            v = 0
            for b in piece:
                nxt = self.child[v].get(b)
                if nxt is None:
                    nxt = self.child[v][b] = len(self.child)
                    self.child.append({})
                    final.append(False)
                v = nxt
            final[v] = True
        size = len(self.child)
        self.fail, self.pops = [0] * size, [0] * size
        turn = deque([0])
        while turn:
            u = turn.popleft()
            for b, v in self.child[u].items():
                if final[v]:
                    self.fail[v], self.pops[v] = 0, 1
                else:
                    z, n = self.fail[u], self.pops[u]
                    while b not in self.child[z]:
                        n += self.pops[z]
                        z = self.fail[z]
                    self.fail[v], self.pops[v] = self.child[z][b], n
                turn.append(v)
        # What is left at the end of a word.
        self.rest = [0] * size
        for v in range(1, size):
            z, n = v, 0
            while z:
                n += self.pops[z]
                z = self.fail[z]
            self.rest[v] = n

    def count(self, word: bytes) -> int:
        child, fail, pops = self.child, self.fail, self.pops
        v = n = 0
        for b in word:
            nxt = child[v].get(b)
            while nxt is None:
                n += pops[v]
                v = fail[v]
                nxt = child[v].get(b)
            v = nxt
        return n + self.rest[v]


def pieces_of(model: str) -> list[bytes]:
    """The pieces of a sentencepiece model, without control pieces and single bytes."""
    from sentencepiece import SentencePieceProcessor

    p = SentencePieceProcessor(model_file=model)
    return [
        p.id_to_piece(i).encode() for i in range(p.get_piece_size())
        if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))
    ]


def automaton(model: str) -> Automaton:
    """One per worker process and vocabulary."""
    if model not in _AUTOMATA:
        _AUTOMATA[model] = Automaton(pieces_of(model))
    return _AUTOMATA[model]


def token_counts(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id, n_words, n_bytes, n_tokens``, a row per row.

    A word is a run of bytes without ASCII white space; its tokens are the greedy
    longest matches of the vocabulary's pieces in the word with the vocabulary's word
    mark before it, and single bytes where there is no piece. ``n_bytes`` counts the
    words' bytes, without white space and marks. A null or empty text has zeros;
    repeated rows and rows without doc_id get a row each; an empty table gives none.
    Other columns are ignored.
    """
    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, memo = automaton(model), {}
        for batch in stream:
            for part in sliced(batch):
                words_, bytes_, tokens_ = [], [], []
                for text in part.column("text").cast(pa.binary()).to_pylist():
                    words = text.split()
                    n = 0
                    for w in words:
                        known = memo.get(w)
                        if known is None:
                            known = machine.count(SPACE + w)
                            if len(w) <= MEMO_BYTES:
                                memo[w] = known
                        n += known
                    if len(memo) > MEMO_WORDS:
                        memo.clear()
                    words_.append(len(words))
                    bytes_.append(sum(map(len, words)))
                    tokens_.append(n)
                yield batches(
                    {"doc_id": part.column("doc_id"), "n_words": words_, "n_bytes": bytes_, "n_tokens": tokens_}, _ROWS
                )

    return arrow_map(texts(docs), task, "doc_id long, n_words long, n_bytes long, n_tokens long")
