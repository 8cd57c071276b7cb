"""SentencePiece encoding with spans in the source text, and decoding.

A text is normalised by the longest prefixes that the model's compiled character map
knows; every character made so remembers the source byte it came from. The pieces
are found in the normalised text, and each is projected to the bytes of the source
between the places that its ends came from.

A BPE merge joins neighbours to a piece of the vocabulary. Between two characters
that are neighbours in no piece nothing is ever joined; so a text is cut there, and
what repeats is looked up.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from innkeep.llm.chunks import Memo
from innkeep.llm.common import arrow_map, batches, sliced, texts
from innkeep.llm.merging import Merges

SPACE = "▁"  # stands for a space in pieces
NEVER = 1 << 60
MEMO_CHARS = 64
MEMO_WORDS = 200_000  # of some 400 bytes each
OTHERS = 1 << 20  # symbols from here on are characters that are no piece
PART_CHARS = 1 << 20  # of a text that are normalised and encoded at a time
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)  # fixed values: kinds of pieces
BPE = 2  # fixed value: the kind of model

_MODELS: dict[str, "PieceModel"] = {}
_DIGESTS = pa.schema([
    ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()),
    ("spans_crc32", pa.int64()),
])
_SPANS = pa.schema([
    ("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("begins", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
])


# ---- the model's file ------------------------------------------------------------


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a message in protocol-buffer encoding."""
    at, size = 0, len(data)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < size:
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            n = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield tag >> 3, data[at:at + n]
            at += n


def character_map(blob: bytes) -> dict[str, str]:
    """The rules of a compiled character map: a double-array trie of the prefixes, whose
    leaves are offsets into the replacements, which end with a zero byte each."""
    if not blob:
        return {}
    size = struct.unpack("<I", blob[:4])[0]
    units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
    said = blob[4 + size:]
    step = lambda u: (u >> 10) << ((u & 512) >> 6)
    rules: dict[str, str] = {}
    todo = [(step(units[0]), b"")]
    while todo:
        base, prefix = todo.pop()
        for byte in range(1, 256):
            node = base ^ byte
            if node >= len(units) or units[node] & 0x800000FF != byte:
                continue
            below = node ^ step(units[node])
            if units[node] >> 8 & 1:
                at = units[below] & 0x7FFFFFFF
                rules[(prefix + bytes([byte])).decode()] = said[at:said.index(0, at)].decode()
            todo.append((below, prefix + bytes([byte])))
    return rules


class Normalizer:
    """Source text to normalised text, with the source byte of every character."""

    def __init__(self, rules: dict[str, str], prefix: bool = True, squeeze: bool = True, escape: bool = True, suffix: bool = False):
        self.rules, self.prefix, self.squeeze, self.suffix = rules, prefix, squeeze, suffix
        self.space = SPACE if escape else " "
        self.longest: dict[str, int] = {}  # of each first character, the longest prefix
        for key in rules:
            self.longest[key[0]] = max(self.longest.get(key[0], 0), len(key))
        # Where a text may be cut before a space: no rule reads over it, and spaces stay.
        self.divides = not squeeze and not suffix and not any(" " in key[1:] for key in rules)

    def parts(self, text: str) -> Iterator[str]:
        """The text, cut before spaces that follow something else, if it is long."""
        at = 0
        while self.divides and len(text) - at > PART_CHARS:
            end = text.find(" ", at + PART_CHARS)
            while end > 0 and text[end - 1] in (" ", self.space):
                end = text.find(" ", end + 1)
            if end < 0:
                break
            yield text[at:end]
            at = end
        yield text[at:] if at else text

    def __call__(self, text: str, first: bool = True) -> tuple[str, np.ndarray]:
        """The normalised part, and for each character of it and its end the source byte."""
        if not self.rules and not self.squeeze and not self.suffix:
            starts = byte_starts(text)
            made = text if self.space == " " else text.replace(" ", self.space)
            if first and self.prefix and text:
                return self.space + made, np.concatenate([starts[:1], starts])
            return made, starts
        return self._by_rules(text, first)

    def _by_rules(self, text: str, first: bool) -> tuple[str, np.ndarray]:
        starts, longest, rules = byte_starts(text).tolist(), self.longest, self.rules
        made: list[str] = []
        source: list[int] = []
        at, size, begun = 0, len(text), False
        after_space = self.squeeze  # spaces are dropped here
        while at < size:
            n, out = 1, text[at]
            for k in range(min(longest.get(out, 0), size - at), 0, -1):
                if (found := rules.get(text[at:at + k])) is not None:
                    n, out = k, found
                    break
            if not begun and self.squeeze and out == " ":
                at += n
                continue
            if not begun:
                begun = True
                if first and self.prefix and not self.suffix:
                    made.append(" ")
                    source.append(starts[at])
            if after_space:
                out = out.lstrip(" ")
            if out:
                made.append(out)
                source += [starts[at]] * len(out)
                after_space = self.squeeze and out.endswith(" ")
            elif not self.squeeze:
                after_space = False
            at += n
        normal, end = "".join(made).replace(" ", self.space), starts[size]
        if self.squeeze:
            kept = len(normal.rstrip(self.space))
            if kept < len(normal):
                normal, end = normal[:kept], source[kept]
                del source[kept:]
        if self.suffix and self.prefix and begun:
            normal += self.space
            source.append(end)
        return normal, np.array([*source, end], np.int64)


def byte_starts(text: str) -> np.ndarray:
    """The byte at which each character begins in UTF-8, and the number of bytes."""
    if text.isascii():
        return np.arange(len(text) + 1)
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    sizes = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
    return np.concatenate([[0], np.cumsum(sizes)])


# ---- pieces ----------------------------------------------------------------------


class PieceModel:
    """A BPE model with byte fallback, from its file; nothing is trained.

    Models of other kinds, without byte fallback, or with user-defined or unused
    pieces are refused with a ``ValueError``.
    """

    def __init__(self, path: str | bytes) -> None:
        if isinstance(path, bytes):
            data = path
        else:
            with open(path, "rb") as f:
                data = f.read()
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        trainer, normal = {}, {}
        for number, value in fields(data):
            if number == 1:
                p = dict(fields(value))
                self.pieces.append(p.get(1, b"").decode())
                scores.append(struct.unpack("<f", p[2])[0] if 2 in p else 0.0)
                self.kinds.append(p.get(3, NORMAL))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normal = dict(fields(value))
        if trainer.get(3, 1) != BPE or not trainer.get(35) or {USER_DEFINED, UNUSED} & {*self.kinds}:
            raise ValueError("not a BPE model with byte fallback and without user-defined or unused pieces")
        self.unknown = trainer.get(44, " ⁇ ".encode()).decode()
        self.normalize = Normalizer(
            character_map(normal.get(2, b"")), bool(normal.get(3, 1)), bool(normal.get(4, 1)), bool(normal.get(5, 1)), bool(trainer.get(24, 0)),
        )
        self.strips = self.normalize.prefix or self.normalize.squeeze
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == NORMAL}
        order = {s: k for k, s in enumerate(sorted({scores[i] for i in self.ids.values()}, reverse=True))}
        self.rank = {p: order[scores[i]] for p, i in self.ids.items()}
        self.bytes_of = {i: int(p[3:-1], 16) for i, p in enumerate(self.pieces) if self.kinds[i] == BYTE}
        self.byte_ids = {b: i for i, b in self.bytes_of.items()}
        self.joined = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        # Words begin at marks, lines at line feeds, if no piece reaches over these.
        self.by_words = not any(x[1] == SPACE != x[0] for x in self.joined) and not any("\n" in x for x in self.joined)
        self.words = Memo(MEMO_WORDS)
        pairs = [
            (self.ids[p[:k]], self.ids[p[k:]], self.rank[p], i)
            for p, i in self.ids.items() for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids
        ]
        self.merges = Merges(*zip(*pairs)) if pairs else Merges([], [], [], [])
        self.symbol = np.arange(OTHERS, OTHERS + 0x110000, dtype=np.int32)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        self.chars = np.array([len(p) for p in self.pieces], np.int64)
        self.byte_id = np.array([self.byte_ids[b] for b in range(256)], np.int32)
        self.digits = [b"%d," % i for i in range(len(self.pieces))]
        self.said = [bytes([self.bytes_of[i]]) if i in self.bytes_of else p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)]

    # -- encoding --

    def merge(self, symbols: list[str]) -> list[str]:
        """Joins neighbours to pieces, best score first, from the left among equals."""
        rank = self.rank.get
        n = len(symbols)
        if n <= 48:
            ranks = [rank(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
            while ranks:
                best = min(ranks)
                if best == NEVER:
                    break
                k = ranks.index(best)
                symbols[k:k + 2] = [symbols[k] + symbols[k + 1]]
                del ranks[k]
                if k < len(ranks):
                    ranks[k] = rank(symbols[k] + symbols[k + 1], NEVER)
                if k:
                    ranks[k - 1] = rank(symbols[k - 1] + symbols[k], NEVER)
            return symbols
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        queue = [(r, k, a + b) for k, (a, b) in enumerate(zip(symbols, symbols[1:])) if (r := rank(a + b)) is not None]
        heapq.heapify(queue)

        def offer(left: int, right: int) -> None:
            both = symbols[left] + symbols[right]
            if (r := rank(both)) is not None:
                heapq.heappush(queue, (r, left, both))

        while queue:
            _, k, both = heapq.heappop(queue)
            right = after[k]
            # Of an offer that is out of date, one of the two has since grown or gone.
            if not symbols[k] or right < 0 or len(symbols[k]) + len(symbols[right]) != len(both):
                continue
            symbols[k], symbols[right] = both, ""
            after[k] = after[right]
            if after[k] >= 0:
                before[after[k]] = k
                offer(k, after[k])
            if before[k] >= 0:
                offer(before[k], k)
        return [s for s in symbols if s]

    def _many(self, words: list[str]) -> list[tuple[bytes, bytes, bytes, bytes]]:
        """Of words in normalised text: ids and lengths in characters (32 bits each), the
        ids' digits with a comma after each, and what the ids decode to."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        return self._made(*self.merges.merge(self.symbol[codes], np.fromiter(map(len, words), np.int64, len(words))))

    def _made(self, symbols: np.ndarray, counts: np.ndarray) -> list[tuple[bytes, bytes, bytes, bytes]]:
        """The same of merged symbols. A character that is no piece becomes its bytes, of
        which the last stands for it."""
        other = symbols >= OTHERS
        codes = symbols[other] - OTHERS
        width = np.ones(len(symbols), np.int64)
        width[other] += (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
        last = np.cumsum(width) - 1
        ids, as_byte = np.repeat(symbols, width), np.repeat(other, width)
        ids[as_byte] = self.byte_id[np.frombuffer(codes.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)]
        sizes = np.zeros(len(ids), "<u4")
        sizes[last] = np.where(other, 1, self.chars[np.where(other, 0, symbols)])
        ends = np.append(0, last + 1)[np.append(0, np.cumsum(counts))].tolist()
        id_bytes, size_bytes, listed = ids.astype("<u4").tobytes(), sizes.tobytes(), ids.tolist()
        digits, said = [self.digits[i] for i in listed], [self.said[i] for i in listed]
        return [
            (id_bytes[4 * a:4 * b], size_bytes[4 * a:4 * b], b"".join(digits[a:b]), b"".join(said[a:b]))
            for a, b in zip(ends, ends[1:])
        ]

    def _long(self, word: str) -> tuple[bytes, bytes, bytes, bytes]:
        """The same of a word of any length, by a queue of its merges."""
        made = [s for bit in self._cut(word) for s in self.merge(list(bit))]
        symbols = np.array([self.ids[s] if s in self.ids else OTHERS + ord(s) for s in made], np.int32)
        return self._made(symbols, np.array([len(symbols)]))[0]

    def _learn(self, keys: set[str]) -> dict[str, tuple]:
        """Make what is not known of the words; long ones are returned and not kept."""
        long: dict[str, tuple] = {}
        fresh: list[str] = []
        for key in self.words.missing(keys):
            if len(key) > MEMO_CHARS:
                long[key] = self._long(key if key[0] == "\n" else SPACE + key)
            else:
                fresh.append(key)
        if fresh:
            self.words.new.update(zip(fresh, self._many([k if k[:1] == "\n" else SPACE + k for k in fresh])))
        return long

    def _cut(self, word: str) -> list[str]:
        """At every place over which no piece reaches."""
        joined, out, at = self.joined, [], 0
        for k in range(1, len(word)):
            if word[k - 1:k + 1] not in joined:
                out.append(word[at:k])
                at = k
        out.append(word[at:])
        return out

    _WORDS = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n[^{SPACE}\n]*")

    def _keys(self, normal: str) -> list[str] | None:
        """The words of a normalised part without the mark before each (words after a
        line feed with it); None if it does not begin with one."""
        if not self.by_words or normal[:1] != SPACE and normal[:1] != "\n":
            return None
        if SPACE + SPACE in normal:
            return [w if w[0] == "\n" else w[1:] for w in self._WORDS.findall(normal)]
        keys = normal.replace("\n", SPACE + "\n").split(SPACE)
        return keys[1:]  # before the first mark, or the one put before the first line feed, is nothing

    def encode_parts(self, texts_: list[str]) -> Iterator[tuple[int, tuple, np.ndarray]]:
        """``(text, (ids, lengths, digits, decoded), source)`` of successive parts; ``source``
        has the source byte of each normalised character and of the end."""
        # Parts of several texts wait until they are worth a look-up together.
        waiting: list[tuple[int, str, np.ndarray]] = []
        held = 0
        for number, text in enumerate(texts_):
            offset, first = 0, True
            for part in self.normalize.parts(text):
                normal, source = self.normalize(part, first)
                if normal:
                    waiting.append((number, normal, source + offset))
                    held += len(normal)
                offset, first = offset + int(source[-1]), False
                if held > PART_CHARS:
                    yield from self._encoded(waiting)
                    waiting, held = [], 0
        yield from self._encoded(waiting)

    def _encoded(self, waiting: list[tuple[int, str, np.ndarray]]) -> Iterator[tuple[int, tuple, np.ndarray]]:
        self.words.turn()
        keyed = [self._keys(normal) for _, normal, _ in waiting]
        wanted: set[str] = set()
        for keys in keyed:
            wanted.update(keys or ())
        long = self._learn(wanted)
        known = self.words.new | long if long else self.words.new
        for (number, normal, source), keys in zip(waiting, keyed):
            made = [self._long(normal)] if keys is None else map(known.__getitem__, keys)
            yield number, tuple(map(b"".join, zip(*made))), source

    # -- decoding --

    def _surface(self, ids: Iterable[int]) -> str:
        """What the pieces say, with spaces for marks; runs of bytes as characters."""
        out: list[str] = []
        held = bytearray()
        for i in ids:
            if (b := self.bytes_of.get(i)) is not None:
                held.append(b)
                continue
            if held:
                out.append(characters(bytes(held)))
                held.clear()
            kind = self.kinds[i]
            out.append("" if kind == CONTROL else self.unknown if kind == UNKNOWN else self.pieces[i].replace(SPACE, " "))
        if held:
            out.append(characters(bytes(held)))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of any ids: control pieces say nothing, the unknown one its own
        surface; the mark that normalisation put before the text goes."""
        first = next((k for k, i in enumerate(ids) if self.kinds[i] != CONTROL), None)
        said = self._surface(ids)
        marked = first is not None and self.kinds[ids[first]] == NORMAL and self.pieces[ids[first]].startswith(SPACE)
        if marked and self.strips:
            said = said.lstrip(" ") if self.normalize.squeeze and not self.pieces[ids[first]].strip(SPACE) else said[1:]
        return said


def characters(data: bytes) -> str:
    """UTF-8, with U+FFFD for each byte that is part of no character."""
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError as e:
        return data[:e.start].decode("utf-8") + "�" + characters(data[e.start + 1:])


def piece_model(path: str) -> PieceModel:
    """One per worker process and model."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


# ---- jobs ------------------------------------------------------------------------


def spans(sizes: np.ndarray, source: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First source byte of each piece, and the one after it."""
    ends = np.cumsum(sizes, dtype=np.int64)
    return source[ends - sizes], source[ends]


def encode(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id, ids, begins, ends``, a row per row: the pieces of each text, and the bytes
    of the text that each came from. A character that is encoded as bytes belongs to
    the last of them. A null or empty text has none; rows without doc_id and repeated
    rows have a row each; an empty table gives none. Other columns are ignored."""

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = piece_model(model)
        for batch in stream:
            for part in sliced(batch, most=1 << 20):
                rows: list[list[list[int]]] = [[[], [], []] for _ in range(part.num_rows)]
                for number, (ids, sizes, _, _), source in m.encode_parts(part.column("text").to_pylist()):
                    begins, ends = spans(np.frombuffer(sizes, "<u4").astype(np.int64), source)
                    for mine, more in zip(rows[number], (np.frombuffer(ids, "<u4"), begins, ends)):
                        mine += more.tolist()
                ids, begins, ends = zip(*rows)
                yield batches({"doc_id": part.column("doc_id"), "ids": ids, "begins": begins, "ends": ends}, _SPANS)

    return arrow_map(texts(docs), task, "doc_id long, ids array<int>, begins array<long>, ends array<long>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id, text`` of rows with ``doc_id`` and ``ids``; null ids are none."""
    out = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = piece_model(model)
        for batch in stream:
            said = [m.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield batches({"doc_id": batch.column("doc_id"), "text": said}, out)

    return arrow_map(encoded.select("doc_id", "ids"), task, "doc_id long, text string")


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, spans_crc32``, a row per row.

    Digests of what ``encode`` and ``decode`` give, without holding it: of the decimal
    ids joined by commas, of the decoded text, and of the spans (first byte and end
    of each piece, unsigned, little-endian, 64 bits). Nulls, empty texts, repeats and
    empty tables as in ``encode``.
    """

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = piece_model(model)
        for batch in stream:
            for part in sliced(batch):
                n = part.num_rows
                count, crc = [0] * n, [0] * n
                ids_hash = [hashlib.sha256() for _ in range(n)]
                text_hash = [hashlib.sha256() for _ in range(n)]
                for k, (ids, sizes, digits, said), source in m.encode_parts(part.column("text").to_pylist()):
                    begins, ends = spans(np.frombuffer(sizes, "<u4").astype(np.int64), source)
                    crc[k] = zlib.crc32(np.stack([begins, ends], 1).astype("<u8").tobytes(), crc[k])
                    ids_hash[k].update(b"," + digits[:-1] if count[k] else digits[:-1])
                    # The first part begins with the mark that normalisation puts there.
                    text_hash[k].update(said[1:] if not count[k] and m.strips and said[:1] == b" " else said)
                    count[k] += len(ids) // 4
                yield batches({
                    "doc_id": part.column("doc_id"), "n_tokens": count, "ids_sha256": [h.hexdigest() for h in ids_hash],
                    "decoded_sha256": [h.hexdigest() for h in text_hash], "spans_crc32": crc,
                }, _DIGESTS)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long"
    return arrow_map(texts(docs), task, schema)
