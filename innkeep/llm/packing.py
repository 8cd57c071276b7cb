"""Best-fit packing of documents into sequences after dominance reduction."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from innkeep.llm.chunks import encoder
from innkeep.llm.common import arrow_map, batches, sliced, texts, written

CAPACITY = 1024

_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()), ("part", pa.int32()), ("rank", pa.int64()),
])


# ---- the plan: numbers of pieces by length ------------------------------------------


class Lengths:
    """A multiset of lengths 1..capacity."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.n = [0] * (capacity + 1)
        for length, c in counts.items():
            self.n[length] += c

    def at_most(self, room: int) -> int:
        """The largest length that is left and fits, or 0."""
        n = self.n
        while room > 0 and not n[room]:
            room -= 1
        return max(room, 0)

    def smallest(self, many: int) -> list[int]:
        """The ``many`` smallest ones."""
        found: list[int] = []
        for length, c in enumerate(self.n):
            if c:
                found += [length] * min(c, many - len(found))
                if len(found) == many:
                    break
        return found


def _best_pair(left: Lengths, room: int) -> tuple[int, int]:
    """Two that fit together with the largest sum, the larger first."""
    best = (0, 0)
    for a in range(min(room - 1, len(left.n) - 1), 0, -1):
        if 2 * a <= sum(best):
            break
        if not left.n[a]:
            continue
        left.n[a] -= 1
        b = left.at_most(min(room - a, a))
        left.n[a] += 1
        if b and a + b > sum(best):
            best = (a, b)
    return best


def _dominating(left: Lengths, j: int, capacity: int) -> list[int] | None:
    """What to put with one piece of length ``j`` (already taken out) such that no
    other filling of its sequence can lead to fewer sequences; None if unknown."""
    room = capacity - j
    few = left.smallest(3)
    if not few or few[0] > room:
        return []  # nothing fits
    largest = left.at_most(room)
    if largest == room or len(few) < 2 or few[0] + few[1] > room:
        return [largest]  # it fills the sequence, or only one more fits
    if len(few) < 3 or sum(few) > room:  # two more fit, not three
        a, b = _best_pair(left, room)
        if largest >= a + b:
            return [largest]
        if a == largest:
            # Any two that fit are no longer than a and b, one by one, unless two
            # longer than b fit together.
            above = [x for x in range(b + 1, capacity + 1) if left.n[x]]
            low = [above[0]] * 2 if above and left.n[above[0]] > 1 else above[:2]
            if len(low) < 2 or sum(low) > room:
                return [a, b]
    return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """``(lengths in a sequence, number of such sequences)`` that hold all pieces.

    First the reduction: from the longest length down, a piece is fixed together
    with a set that dominates every other set that fits with it. It holds for as
    many alike as the lengths allow, so whole classes are fixed at once. The rest is
    packed by best fit, longest first: each piece goes to the fullest sequence that
    has room; open sequences of one remaining room are a class too.
    """
    left = Lengths(counts, capacity)
    made: list[tuple[list[int], int]] = []
    kept = [0] * (capacity + 1)
    for j in range(capacity, 0, -1):
        while left.n[j]:
            left.n[j] -= 1
            mates = _dominating(left, j, capacity)
            left.n[j] += 1
            if mates is None:
                break
            need = {x: [j, *mates].count(x) for x in {j, *mates}}
            # While every length of the set is left, the same set dominates: fewer
            # pieces elsewhere only take other choices away. Where copies of j
            # are among the mates, one set may be the last of its kind.
            times = min(left.n[x] // c for x, c in need.items())
            for x, c in need.items():
                left.n[x] -= c * times
            made.append(([j, *mates], times))
    kept = left.n
    # Best fit of the rest. open_[room] holds (content, number) of open sequences.
    open_: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]
    for j in range(capacity, 0, -1):
        todo = kept[j]
        room = j
        while todo and room <= capacity:
            # The fullest with room; what it becomes has less room, maybe for j again.
            if not open_[room]:
                room += 1
                continue
            content, number = open_[room].pop()
            times = min(number, todo)
            if number > times:
                open_[room].append((content, number - times))
            open_[room - j].append((content + (j,), times))
            todo -= times
            room = max(j, room - j)
        if todo:
            fill = capacity // j
            if todo >= fill:
                open_[capacity - fill * j].append(((j,) * fill, todo // fill))
            if todo % fill:
                open_[capacity - todo % fill * j].append(((j,) * (todo % fill), 1))
    made += [(list(content), number) for row in open_ for content, number in row]
    return made


def intervals(made: list[tuple[list[int], int]]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, first sequence, offset, slots): the pieces of
    that length from that rank on take ``slots`` neighbouring places in each of the
    following sequences, the first at ``offset``."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for lengths, number in made:
        offset, at = 0, 0
        ordered = sorted(lengths, reverse=True)
        while at < len(ordered):
            length = ordered[at]
            slots = ordered.count(length)
            rows.setdefault(length, []).append((used.get(length, 0), sequence, offset, slots))
            used[length] = used.get(length, 0) + slots * number
            offset += slots * length
            at += slots
        sequence += number
    return {k: np.array(v, np.int64) for k, v in rows.items()}


# ---- jobs -----------------------------------------------------------------------


def pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document, numbered within task and length.

    A document of more than ``capacity`` ids is cut from its end, so that its first
    piece alone may be shorter.
    """

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(vocabulary).encode, TaskContext.get().partitionId()
        end, seen = int(end_id).to_bytes(4, "little"), [0] * (capacity + 1)
        for batch in stream:
            for some in sliced(batch):
                rows = []
                for doc_id, ids in zip(some.column("doc_id").to_pylist(), encode(some.column("text"))):
                    ids = memoryview(ids + end)
                    n = len(ids) // 4
                    start, stop = 0, (n - 1) % capacity + 1
                    k = 0
                    while start < n:
                        length = stop - start
                        rows.append((doc_id, k, start, length, zlib.crc32(ids[4 * start:4 * stop]), part, seen[length]))
                        seen[length] += 1
                        start, stop, k = stop, stop + capacity, k + 1
                yield batches(dict(zip(_PIECES.names, map(list, zip(*rows)))), _PIECES)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"
    return arrow_map(texts(docs), task, schema)


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, a row per piece.

    The driver gets the number of pieces of each length (``capacity`` numbers at
    most, whatever the input) and plans with these; the pieces find their places by
    their rank among those of their length: rank in the task, plus the pieces of
    that length in tasks before.

    A null or empty text is a document of the end id alone. Repeated rows are
    packed each; rows without doc_id too. An empty table gives no rows. Other
    columns are ignored.
    """
    cut = written(pieces(docs, vocabulary, end_id, capacity), "pieces")
    per_task = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(
        per_task.select("length", "part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "ranks"
    )
    counts = {r["length"]: r["n"] for r in bases.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = intervals(plan(counts, capacity))
    out = pa.schema([
        ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
        ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
    ])

    def place(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("rank").to_numpy() + batch.column("base").to_numpy()
            sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            found, first = np.unique(lengths[order], return_index=True)
            for length, a, b in zip(found.tolist(), first, [*first[1:], len(lengths)]):
                rows, known = order[a:b], places[length]
                at = known[np.searchsorted(known[:, 0], ranks[rows], side="right") - 1]
                past = ranks[rows] - at[:, 0]
                sequence[rows] = at[:, 1] + past // at[:, 3]
                offset[rows] = at[:, 2] + past % at[:, 3] * length
            same = {c: batch.column(c) for c in out.names[:5]}
            yield batches({**same, "sequence_id": pa.array(sequence), "offset": pa.array(offset)}, out)

    ranked = cut.join(bases.select("length", "part", "base"), ["length", "part"])
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return arrow_map(ranked, place, schema)
