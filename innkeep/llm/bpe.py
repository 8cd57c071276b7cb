"""Byte-pair encoding as a streaming transducer, and incremental decoding.

How far back can more text change the tokens of a text? Merges run in the order of
the merge list. Two texts that agree up to some place are merged alike, except for
what the difference behind that place reaches: it starts there, and moves left only
by a merge (x, y) that one text makes and the other does not, by the length of x.
The y of such a merge begins where the difference begun so far; so it begins with
the result of the merge before, or with that one's x. And each is later in the list
than the one before. The longest such chain of merges, by the lengths of their x, is
the lookahead that suffices; it follows from the list alone (``lookahead``).

So the encoder is a transducer: it reads a text in blocks, keeps what is not yet
settled, and emits the rest. Settled is all before the last place where a word
begins for certain; and, in a word that is longer than the lookahead, the tokens
that end more than the lookahead before the end of what has been read. What stays
is a word, or the lookahead and one block, whatever the length of the text.

Words that are settled are looked up; those not known are merged many at a time.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from innkeep.llm.chunks import Memo, cut, piece_of
from innkeep.llm.common import arrow_map, batches, sliced, texts
from innkeep.llm.merging import Merges

BLOCK_BYTES = 4096  # of a word, read at a time
BLOCK_CHARS = 1 << 16  # of a text, read at a time
TURN_CHARS = 1 << 20  # of settled text that is looked up at a time
MEMO_PIECES = 200_000  # of some 400 bytes each
MEMO_CHARS = 64
NEVER = 1 << 60
# Fixed value: the vocabulary's pattern that splits text before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_CODECS: dict[str, "Codec"] = {}
_ROWS = pa.schema([
    ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()),
])


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable
    Latin-1 characters for themselves, the others from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


class Codec:
    """A merge list with its vocabulary, from a tokenizer file; a path is needed to
    load it in each worker process, nothing is trained."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab: dict[str, int] = spec["model"]["vocab"]
        as_bytes = lambda token: bytes(letters[c] for c in token)
        self.bytes_of = {i: as_bytes(t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # A decoder takes an added token's letters for bytes too, if all are letters of bytes.
        for content, i in self.special.items():
            known = all(c in letters for c in content)
            self.bytes_of[i] = as_bytes(content) if known else content.encode()
        self.byte_ids = [0] * 256
        for token, i in vocab.items():
            if len(token) == 1 and token in letters:
                self.byte_ids[letters[token]] = i
        self.rank: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []  # what the merge of each rank makes
        for rank, pair in enumerate(spec["model"]["merges"]):
            x, y = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocab[x], vocab[y]] = rank
            self.merged.append(vocab[x + y])
        self.lookahead = self._sufficient_lookahead()
        self.split = regex.compile(PATTERN)
        self.specials = regex.compile("|".join(regex.escape(s) for s in self.special)) if self.special else None
        # A match is final once this much follows it: a contraction, or the longest special token.
        self.margin = 4 + max(map(len, self.special), default=0)
        self.divides = not any(c.isspace() for t in self.special for c in t)
        left, right = zip(*self.rank) if self.rank else ((), ())
        self.merges = Merges(left, right, list(self.rank.values()), [self.merged[r] for r in self.rank.values()])
        self.symbol = np.array(self.byte_ids, np.int32)
        size = max(self.bytes_of) + 1
        self.digits = [b"%d," % i for i in range(size)]
        self.said = [self.bytes_of.get(i, b"") for i in range(size)]
        # By the piece, and by what follows its space.
        self.whole, self.spaced = Memo(MEMO_PIECES), Memo(MEMO_PIECES)

    def _sufficient_lookahead(self) -> int:
        order = [(x, y, self.merged[r]) for (x, y), r in sorted(self.rank.items(), key=lambda m: -m[1])]
        first_part = {z: x for x, _, z in reversed(order)}
        longest: dict[int, int] = {}  # of a token: the longest chain of later merges whose y begins with it
        best = 0
        for x, y, z in order:
            chain = len(self.bytes_of[x]) + max(longest.get(z, 0), longest.get(x, 0))
            best = max(best, chain)
            t: int | None = y
            while t is not None:
                if chain > longest.get(t, 0):
                    longest[t] = chain
                t = first_part.get(t)
        return best

    # -- encoding --

    def _merge(self, ids: list[int]) -> list[int]:
        """Merges in the order of the list, from the left among equals."""
        rank, merged = self.rank.get, self.merged
        n = len(ids)
        if n <= 48:
            ranks = [rank(pair, NEVER) for pair in zip(ids, ids[1:])]
            while ranks:
                best = min(ranks)
                if best == NEVER:
                    break
                k = ranks.index(best)
                ids[k:k + 2] = [merged[best]]
                del ranks[k]
                if k < len(ranks):
                    ranks[k] = rank((ids[k], ids[k + 1]), NEVER)
                if k:
                    ranks[k - 1] = rank((ids[k - 1], ids[k]), NEVER)
            return ids
        after = [*range(1, n), -1]
        before = [*range(-1, n - 1)]
        queue = [(r, k, *pair) for k, pair in enumerate(zip(ids, ids[1:])) if (r := rank(pair)) is not None]
        heapq.heapify(queue)
        while queue:
            r, k, x, y = heapq.heappop(queue)
            right = after[k]
            if ids[k] != x or right < 0 or ids[right] != y:
                continue
            z = ids[k] = merged[r]
            ids[right] = -1
            after[k] = after[right]
            if after[k] >= 0:
                before[after[k]] = k
                if (r := rank((z, ids[after[k]]))) is not None:
                    heapq.heappush(queue, (r, k, z, ids[after[k]]))
            left = before[k]
            if left >= 0 and (r := rank((ids[left], z))) is not None:
                heapq.heappush(queue, (r, left, ids[left], z))
        return [i for i in ids if i >= 0]

    def transduce(self, blocks: Iterable[bytes]) -> Iterator[list[int]]:
        """The ids of one word that comes in blocks of bytes, as they become stable."""
        byte_ids, length = self.byte_ids, self.bytes_of
        held = b""
        for block in blocks:
            held += block
            if len(held) < self.lookahead + BLOCK_BYTES:
                continue
            ids = self._merge([byte_ids[b] for b in held])
            settled, end, out = len(held) - self.lookahead, 0, []
            for i in ids:
                if end + len(length[i]) > settled:
                    break
                end += len(length[i])
                out.append(i)
            held = held[end:]
            yield out
        if held:
            yield self._merge([byte_ids[b] for b in held])

    def _words(self, text: str) -> Iterator[list[int]]:
        """The ids of whole words, in parts."""
        at = 0
        for hit in [*self.specials.finditer(text)] if self.specials else ():
            yield from self._plain(text[at:hit.start()])
            yield [self.special[hit.group()]]
            at = hit.end()
        yield from self._plain(text[at:])

    def _plain(self, text: str) -> Iterator[list[int]]:
        for word in self.split.finditer(text):
            yield from self.transduce(_blocks(word.group().encode("utf-8")))

    def settled(self, text: str) -> Iterator[str | list[int]]:
        """A text as it is read: stretches of whole words, and of long words ids.

        The state is what has been read and is not settled. Words begin for certain
        at a space between two characters that are none.
        """
        held = ""
        for at in range(0, len(text), BLOCK_CHARS):
            held += text[at:at + BLOCK_CHARS]
            if at + BLOCK_CHARS >= len(text):
                break
            if not self.divides:
                continue
            place = held.rfind(" ")
            while place > 0 and (held[place - 1].isspace() or held[place + 1:place + 2].isspace() or place + 1 == len(held)):
                place = held.rfind(" ", 0, place)
            if place > 0:
                yield held[:place]
                held = held[place:]
            elif len(held) > 4 * BLOCK_CHARS:
                done, held = self._without_spaces(held)
                yield from done
        if held:
            yield held

    def _without_spaces(self, held: str) -> tuple[list[str | list[int]], str]:
        """What is settled where no word begins for certain, and the rest."""
        begin = 0
        for hit in self.specials.finditer(held) if self.specials else ():
            begin = hit.end()
        done: list[str | list[int]] = [held[:begin]] if begin else []
        ends = [m.end() for m in self.split.finditer(held, begin)]
        final = [e for e in ends[:-3] if e <= len(held) - self.margin]
        if final:
            done += [i for i in self._plain(held[begin:final[-1]])]
            begin = final[-1]
        # A word without an end: its tokens before the lookahead, up to a whole character.
        word = next(iter(self.split.finditer(held, begin)), None)
        if word is not None and word.end() > len(held) - self.margin:
            data = word.group().encode("utf-8")
            ids = self._merge([self.byte_ids[b] for b in data])
            end, stop, best = 0, len(data) - max(self.lookahead, 4 * self.margin), (0, 0)
            for n, i in enumerate(ids, 1):
                end += len(self.bytes_of[i])
                if end > stop:
                    break
                if data[end] & 0xC0 != 0x80:
                    best = n, end
            done.append(ids[:best[0]])
            begin = word.start() + len(data[:best[1]].decode("utf-8"))
        return done, held[begin:]

    def encode(self, text: str) -> Iterator[list[int]]:
        """The ids of a text, in parts, as it is read."""
        for _, ids, _, _ in self.encode_parts([text]):
            yield np.frombuffer(ids, "<u4").tolist()

    def encode_parts(self, texts_: Iterable[str]) -> Iterator[tuple[int, bytes, bytes, bytes]]:
        """Of successive settled stretches the text's place, the ids (32 bits each), their
        digits with a comma after each, and the bytes they stand for."""
        waiting: list[tuple[int, str | list[int]]] = []
        held = 0
        for number, text in enumerate(texts_):
            for stretch in self.settled(text):
                waiting.append((number, stretch))
                held += len(stretch)
                if held > TURN_CHARS:
                    yield from self._looked_up(waiting)
                    waiting, held = [], 0
        yield from self._looked_up(waiting)

    def _looked_up(self, waiting: list[tuple[int, str | list[int]]]) -> Iterator[tuple[int, bytes, bytes, bytes]]:
        self.whole.turn()
        self.spaced.turn()
        both = [cut(s) if isinstance(s, str) else None for _, s in waiting]
        whole: set[str] = set()
        spaced: set[str] = set()
        for keys in both:
            if keys:
                whole.update(keys[0])
                spaced.update(keys[1])
        long_whole = self._learn(self.whole, whole, str)
        long_spaced = self._learn(self.spaced, spaced, piece_of)
        w = self.whole.new | long_whole if long_whole else self.whole.new
        s = self.spaced.new | long_spaced if long_spaced else self.spaced.new
        for (number, stretch), keys in zip(waiting, both):
            if keys is None:
                yield number, *self._made(stretch)
                continue
            made = [*map(w.__getitem__, keys[0]), *map(s.__getitem__, keys[1])]
            if made:
                yield number, *map(b"".join, zip(*made))

    def _made(self, ids: list[int]) -> tuple[bytes, bytes, bytes]:
        return (
            np.array(ids, "<u4").tobytes(), b"".join([self.digits[i] for i in ids]), b"".join([self.said[i] for i in ids])
        )

    def _learn(self, memo: Memo, keys: set[str], piece) -> dict[str, tuple[bytes, bytes, bytes]]:
        """Make what is not known; long pieces are returned and not kept."""
        long: dict[str, tuple[bytes, bytes, bytes]] = {}
        fresh: list[str] = []
        words: list[str] = []
        bounds = [0]
        for key in memo.missing(keys):
            text = piece(key)
            if len(key) > MEMO_CHARS or self.specials and self.specials.search(text):
                long[key] = self._made([i for part in self._words(text) for i in part])
                continue
            fresh.append(key)
            if key.isascii() and key.isalpha():
                words.append(text)
            else:
                words += self.split.findall(text)
            bounds.append(len(words))
        if fresh:
            data = [w.encode("utf-8") for w in words]
            symbols = self.symbol[np.frombuffer(b"".join(data), np.uint8)]
            ids, counts = self.merges.merge(symbols, np.fromiter(map(len, data), np.int64, len(data)))
            ends = np.append(0, np.cumsum(counts))[bounds].tolist()
            as_bytes, listed = ids.astype("<u4").tobytes(), ids.tolist()
            digits, said = [self.digits[i] for i in listed], [self.said[i] for i in listed]
            memo.new.update(zip(fresh, [
                (as_bytes[4 * a:4 * b], b"".join(digits[a:b]), b"".join(said[a:b])) for a, b in zip(ends, ends[1:])
            ]))
        return long

    # -- decoding --

    def decode(self, parts: Iterable[list[int]]) -> Iterator[str]:
        """Text from ids as they come. The state is the bytes of an unfinished character;
        what cannot be one becomes U+FFFD."""
        state = codecs.getincrementaldecoder("utf-8")("replace")
        bytes_of = self.bytes_of
        for ids in parts:
            yield state.decode(b"".join([bytes_of[i] for i in ids]))
        yield state.decode(b"", final=True)


def _blocks(data: bytes) -> Iterator[bytes]:
    for at in range(0, len(data), BLOCK_BYTES):
        yield data[at:at + BLOCK_BYTES]


def codec(path: str) -> Codec:
    """One per worker process and vocabulary."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def round_trips(texts_: list[str], path: str) -> tuple[list[int], list[str], list[str]]:
    """Of each text the number of ids, the SHA-256 of the ids in decimal joined by commas,
    and that of what they decode to; neither is held whole."""
    c, n = codec(path), len(texts_)
    count = [0] * n
    ids_hash, text_hash = [hashlib.sha256() for _ in range(n)], [hashlib.sha256() for _ in range(n)]
    state = codecs.getincrementaldecoder("utf-8")("replace")
    last = 0
    for k, ids, digits, said in c.encode_parts(texts_):
        if k != last:
            text_hash[last].update(state.decode(b"", final=True).encode("utf-8"))
            last = k
        if ids:
            ids_hash[k].update(b"," + digits[:-1] if count[k] else digits[:-1])
            count[k] += len(ids) // 4
            text_hash[k].update(state.decode(said).encode("utf-8"))
    if n:
        text_hash[last].update(state.decode(b"", final=True).encode("utf-8"))
    return count, [h.hexdigest() for h in ids_hash], [h.hexdigest() for h in text_hash]


def encode_decode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``, a row per row.

    A null text is an empty one; an empty text has no ids. Repeated rows and rows
    without doc_id get a row each; an empty table gives none. Other columns are
    ignored.
    """
    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in sliced(batch):
                n, ids, text = round_trips(part.column("text").to_pylist(), vocabulary)
                yield batches(
                    {"doc_id": part.column("doc_id"), "n_tokens": n, "ids_sha256": ids, "decoded_sha256": text}, _ROWS
                )

    return arrow_map(texts(docs), task, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
