"""Embedding near-duplicates by randomised-rotation binary codes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeep.llm.common import arrow_map, batches, by_block, components, local_roots, runs, written

THRESHOLD = 0.9
SEED = 20240
# Components of the vectors in one block of a unit of work, and rows in it at most.
BLOCK_SIZE, BLOCK_VECTORS = 1 << 20, 16_384
LEAST_BLOCKS = 8  # of a table of some size, so that small tables are spread too
PIVOTS = 1024
# Width of the confidence bound in standard deviations: a linked pair is missed by
# the codes with a probability below 1e-8.
SIGMAS = 6.0

_LINKS = pa.schema([("no", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every process."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def reach(threshold: float) -> float:
    """The sine of the angle at the threshold; 1 if that angle is not acute."""
    return math.sqrt(max(1 - threshold * threshold, 0)) if threshold > 0 else 1.0


class Codes:
    """What is stored of unit vectors, after one random rotation: a sign bit a dimension,
    eight bits a dimension, and correction factors.

    For unit o and its signs x (of length one), <x, q> / <x, o> estimates <o, q> without
    bias over the rotations, with a standard deviation of
    sqrt((1 - <x, o>^2) / <x, o>^2 / (dim - 1)); ``factor`` is <x, o>. For q its eight
    bits stand, ``step`` times a whole number, at a distance of ``off`` from q. All sums
    are of whole numbers and exact, so a pair is judged alike wherever it meets.
    """

    def __init__(self, bits: np.ndarray, whole: np.ndarray, factor: np.ndarray, step: np.ndarray, off: np.ndarray) -> None:
        self.dim = whole.shape[1]
        self.signs = np.unpackbits(bits, axis=1, count=self.dim).astype(np.float32) * 2 - 1
        self.exact = np.float32 if self.dim * 127**2 < 1 << 24 else np.float64
        self.whole = whole.astype(self.exact)
        self.factor, self.step, self.off = (x.astype(np.float64) for x in (factor, step, off))
        spread = np.sqrt(np.maximum(1 - self.factor**2, 0)) / self.factor
        self.spread, self.error = spread, SIGMAS * spread / math.sqrt(max(self.dim - 1, 1))

    @staticmethod
    def packed(unit: np.ndarray) -> list[bytes]:
        """The record of each vector."""
        dim = unit.shape[1]
        turned = unit @ rotation(dim, SEED)
        bits = turned > 0
        factor = (np.where(bits, turned, -turned).sum(axis=1) / math.sqrt(dim)) * (1 - 1e-6)  # no larger in 32 bits
        step = (np.abs(turned).max(axis=1) / 127).astype(np.float32)
        whole = np.clip(np.rint(turned / step[:, None].astype(np.float64)), -127, 127).astype(np.int8)
        off = np.linalg.norm(turned - whole * step[:, None].astype(np.float64), axis=1) * (1 + 1e-5) + 1e-9
        head = np.stack([factor, step, off], axis=1).astype("<f4")
        packed = np.packbits(bits, axis=1)
        return [h.tobytes() + p.tobytes() + w.tobytes() for h, p, w in zip(head, packed, whole)]

    @classmethod
    def read(cls, records: list[bytes], dim: int) -> "Codes":
        size = -(-dim // 8)
        data = np.frombuffer(b"".join(records), np.uint8).reshape(len(records), 12 + size + dim)
        head = np.ascontiguousarray(data[:, :12]).view("<f4")
        whole = np.ascontiguousarray(data[:, 12 + size:]).view(np.int8)
        return cls(np.ascontiguousarray(data[:, 12:12 + size]), whole, head[:, 0], head[:, 1], head[:, 2])

    def may_reach(self, left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
        """For which pairs the bound of the estimate reaches the threshold.

        The part of q that is orthogonal to o is no longer than the sine of their
        angle, so the error of a linked pair is at most spread * reach in any case.
        Up to 190 dimensions, at 0.9, that is the narrower bound: no linked pair is
        lost. Beyond, the confidence bound decides.
        """
        error = np.minimum(self.error, self.spread * reach(threshold))
        least = ((threshold - error[left]) * self.factor[left] - 1e-5) * math.sqrt(self.dim)
        sums = self.signs[left] @ self.whole[right].T.astype(np.float32)  # whole numbers below 2^24
        slack = (self.off[right] * math.sqrt(self.dim)).astype(np.float32) * np.float32(1 + 1e-5)
        return sums * self.step[right].astype(np.float32) + slack >= least[:, None].astype(np.float32)

    def between(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact bounds of the cosines of pairs, from the eight bits."""
        middle = np.einsum("ij,ij->i", self.whole[a], self.whole[b]).astype(np.float64) * self.step[a] * self.step[b]
        slip = self.off[a] + self.off[b] + 3 * self.off[a] * self.off[b] + 1e-9
        return middle - slip, middle + slip


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id``, ``v`` as doubles; ``v`` is null where nothing can link."""
    v = F.transform(F.col("raw"), lambda c: c.cast("double"))
    whole = F.forall("d", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    some = F.exists("d", lambda c: c != 0)
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vec_col].alias("raw")).select("id", v.alias("d"))
    # -0.0 and 0.0 are one value here.
    same = F.transform("d", lambda c: F.when(c == 0, F.lit(0.0)).otherwise(c))
    return rows.select("id", F.when(whole & some, same).alias("v"))


def _unit(v: np.ndarray) -> np.ndarray:
    """Of length one; scaled first, so that no square overflows or vanishes."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


_CELLS = pa.schema([
    ("no", pa.int64()), ("rep", pa.int64()), ("copies", pa.int64()), ("h", pa.int64()), ("cell", pa.int32()), ("u", pa.binary()), ("code", pa.binary()),
])
_UNITS = pa.schema([("no", pa.int64()), ("rep", pa.int64()), ("copies", pa.int64()), ("_i", pa.int32()), ("_j", pa.int32()), ("_side", pa.int32()), ("code", pa.binary())])
# A link as (no, a, b, n); or, with n = -1, a class whose exact vector the unit of work needs.
_FOUND = pa.schema([*_LINKS, ("_i", pa.int32()), ("_j", pa.int32()), ("_side", pa.int32())])


def _assign(stream: Iterator[pa.RecordBatch], pivots: np.ndarray, kind: type) -> Iterator[pa.RecordBatch]:
    """Each class with the pivot nearest to it, and its code."""
    dim = pivots.shape[1]
    for batch in stream:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            v = part.column("v").flatten().to_numpy().reshape(part.num_rows, dim)
            unit = _unit(v)
            yield batches({
                **{c: part.column(c) for c in ("no", "rep", "copies", "h")},
                "cell": (unit @ pivots.T).argmax(axis=1).astype(np.int32), "u": [x.tobytes() for x in v.astype(kind)],
                "code": Codes.packed(unit),
            }, _CELLS)


def may_meet(unit: np.ndarray, cell: np.ndarray, pivots: np.ndarray, threshold: float) -> np.ndarray:
    """For each vector the cells that may hold one at or above the threshold.

    Vectors of cell D lie on D's side of the plane midway between the pivots C and D.
    One of cell C whose angle to that plane is larger than the threshold's has no
    link there. The bound is exact: what it excludes cannot link.
    """
    dots = unit @ pivots.T
    apart = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))
    return dots[np.arange(len(unit)), cell][:, None] - dots <= reach(threshold) * apart[cell] + 1e-7


def _place(stream: Iterator[pa.RecordBatch], pivots: np.ndarray, blocks: np.ndarray, threshold: float, kind: type) -> Iterator[pa.RecordBatch]:
    """Each class once for every block that it has to meet: units of work as in
    ``in_blocks``, with the blocks of all cells in one numbering."""
    dim = pivots.shape[1]
    first = np.cumsum(blocks) - blocks
    of_block = np.repeat(np.arange(len(blocks)), blocks)
    step = max(1, (1 << 21) // (len(of_block) * dim))
    for batch in stream:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            cell, h = part.column("cell").to_numpy(), part.column("h").to_numpy()
            unit = _unit(np.frombuffer(b"".join(part.column("u").to_pylist()), kind).reshape(-1, dim).astype(np.float64))
            row, other = np.nonzero(may_meet(unit, cell, pivots, threshold)[:, of_block])
            side = (first[cell] + h % blocks[cell])[row]
            where = pa.array(row)
            yield batches({
                **{c: part.column(c).take(where) for c in ("no", "rep", "copies")},
                "_i": np.minimum(side, other).astype(np.int32), "_j": np.maximum(side, other).astype(np.int32),
                "_side": side.astype(np.int32), "code": part.column("code").take(where),
            }, _UNITS)


def _link(stream: Iterator[pa.RecordBatch], threshold: float, dim: int, kind: type | None) -> Iterator[pa.RecordBatch]:
    """For each unit of work, rows (no, a, b, n): class ``no``, named a, has n linked vectors
    here, and b is the smallest name it is connected with here.

    Without ``kind`` from the codes alone: of the pairs that the estimate's bound leaves,
    those that link for certain, and rows for the classes of those that are uncertain.
    With it the rows are such classes with their exact vectors of that kind, and the
    cosines of the uncertain pairs are computed.
    """
    out: list[tuple[np.ndarray, ...]] = []
    size = 0
    for run in runs(stream, ["_i", "_j"]):
        rows = sum(b.num_rows for b in run)
        if rows < 2:
            continue
        i, j = (run[0].column(c)[0].as_py() for c in ("_i", "_j"))
        numbers = np.concatenate([b.column("no").to_numpy() for b in run])
        order = np.argsort(numbers)  # so that a pair is in one order in both passes
        column = lambda c: np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in run])[order]
        numbers, ids, side, copies = numbers[order], column("rep"), column("_side"), column("copies")
        left = np.arange(rows) if i == j else np.flatnonzero(side == i)
        right = left if i == j else np.flatnonzero(side == j)
        if not len(left) or not len(right):
            continue
        codes = Codes.read(column("code").tolist(), dim)
        unit = None if kind is None else _unit(np.frombuffer(b"".join(column("u").tolist()), kind).reshape(rows, -1).astype(np.float64))
        links, asked = np.zeros(rows), np.zeros(rows, bool)
        # Places in the order of the names; a component's root is its first.
        named = np.argsort(ids, kind="stable")
        place = np.empty(rows, np.int64)
        place[named] = np.arange(rows)
        roots = np.arange(rows)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def join() -> np.ndarray:
            x, y = map(np.concatenate, zip((np.arange(rows), roots), *held))
            held.clear()
            return local_roots(rows, x, y)

        step, few, n = max(1, (1 << 20) // len(right)), max(1, (1 << 21) // dim), 0
        for at in range(0, len(left), step):
            block = left[at:at + step]
            # Within a block, of each pair the one order.
            ahead = right[at:] if i == j else right
            x, y = np.nonzero(codes.may_reach(block, ahead, threshold))
            x, y = block[x], ahead[y]
            if i == j:
                x, y = x[x < y], y[x < y]
            for p in range(0, len(x), few):  # a bounded number at a time
                a, b = x[p:p + few], y[p:p + few]
                low, high = codes.between(a, b)
                open_ = (low < threshold) & (high >= threshold)
                if unit is None:
                    near = low >= threshold
                    asked[a[open_]] = asked[b[open_]] = True
                else:
                    a, b = a[open_], b[open_]
                    near = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
                a, b = a[near], b[near]
                links += np.bincount(a, copies[b], rows) + np.bincount(b, copies[a], rows)
                held.append((place[a], place[b]))
                n += len(a)
                if n > 1 << 20:
                    roots, n = join(), 0
        roots = join()
        root = ids[named][roots][place]
        for keep, is_link in (((links > 0) | (root != ids), True), (asked, False)):
            k = int(keep.sum())
            if k:
                unit_of = (np.full(k, i, np.int32), np.full(k, j, np.int32), side[keep].astype(np.int32))
                out.append((numbers[keep], ids[keep], root[keep], np.where(is_link, links[keep], -1).astype(np.int64), *unit_of))
                size += k
        if size > 50_000:
            yield _found(out)
            out, size = [], 0
    if size:
        yield _found(out)


def _found(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    return batches(dict(zip(_FOUND.names, map(np.concatenate, zip(*parts)))), _FOUND)


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vec_col: str = "embedding",
    block_rows: int = BLOCK_VECTORS,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per row, by cosine.

    Equal vectors are one class, named by its smallest id, and are never paired;
    each has the others of its class as links. Classes form cells around pivots, and
    cells are dealt to blocks. Any two blocks meet, less the classes that cannot link
    there by an exact bound of angles (``may_meet``): no pair is left out. What a block
    gets of a class is its code, 84 bytes at 64 dimensions, which is stored once. The
    estimate's bound excludes most pairs; of the rest, eight-bit bounds tell what links
    for certain and what does not. The exact vectors of classes with uncertain pairs,
    each once a unit of work, then decide these. Each pair meets once. A unit of work returns numbers of links and a spanning star, not pairs. Where
    the cells exclude little, as for unrelated vectors, the work grows with the square of
    the rows.

    Vectors that are null, empty or zero or hold a null or non-finite component
    link with nothing, and are each their own component. Vectors of different
    lengths do not link. Rows that repeat an id: each gets a row, with the links of
    its own vector; equal ids are one node. Rows without id get no component and
    are not kept. An empty table gives no rows. Other columns are ignored.
    """
    rows = written(usable(vectors, id_col, vec_col), "vectors")
    classes = rows.where("v is not null and id is not null").groupBy("v").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")
    )
    # Two vectors of one id are two classes of one name; the number, which the written table keeps, tells them apart.
    classes = written(classes.withColumn("no", F.monotonically_increasing_id()), "vector-classes")
    found = None
    floats = isinstance(vectors.schema[vec_col].dataType, T.ArrayType) and isinstance(vectors.schema[vec_col].dataType.elementType, T.FloatType)
    kind = np.float32 if floats else np.float64
    for r in sorted(classes.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()):
        dim, n = r["dim"], r["n"]
        block = min(block_rows, max(64, BLOCK_SIZE // dim), max(256, -(-n // LEAST_BLOCKS)))
        own = classes.where(F.size("v") == dim).select("no", "v", "rep", "copies", F.xxhash64("rep", F.lit(17)).alias("h"))
        few = min(PIVOTS, max(1, BLOCK_SIZE // dim), -(-n // block))
        pivots = _unit(np.array([p["v"] for p in own.orderBy("h", "rep").limit(few).select("v").collect()], dtype=np.float64))
        cells = arrow_map(own, lambda s, p=pivots: _assign(s, p, kind), "no long, rep long, copies long, h long, cell int, u binary, code binary")
        cells = written(cells, "vector-cells")
        blocks = np.zeros(len(pivots), np.int64)
        for c in cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():
            blocks[c["cell"]] = -(-c["n"] // block)
        placed = arrow_map(
            cells, lambda s, p=pivots, b=blocks: _place(s, p, b, threshold, kind),
            "no long, rep long, copies long, _i int, _j int, _side int, code binary",
        )
        schema = "no long, a long, b long, n long, _i int, _j int, _side int"
        judged = arrow_map(by_block(placed, []), lambda s, d=dim: _link(s, threshold, d, None), schema)
        judged = written(judged, "vector-judged")
        # Exact vectors go only where pairs are uncertain, a class once a unit of work.
        asked = judged.where("n < 0").select("no", "_i", "_j", "_side")
        exact = asked.join(cells.select("no", "rep", "copies", "u", "code"), "no")
        sure = arrow_map(by_block(exact, []), lambda s, d=dim: _link(s, threshold, d, kind), schema)
        links = judged.where("n >= 0").select(*_LINKS.names).unionByName(sure.where("n >= 0").select(*_LINKS.names))
        found = links if found is None else found.unionByName(links)
    if found is None:
        links = None
        known = classes.select("v", "rep", "copies", F.lit(0).cast("long").alias("n"), F.col("rep").alias("component_id"))
    else:
        links = written(found, "vector-links")
        numbers = links.groupBy(F.col("no").alias("of")).agg(F.sum("n").alias("n"))
        roots = components(links.select("a", "b"))
        known = classes.join(numbers, classes["no"] == numbers["of"], "left").join(
            roots, classes["rep"] == roots["id"], "left"
        ).select("v", "rep", "copies", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("component_id", "rep").alias("component_id"))
    own = known.select(F.col("v").alias("w"), "copies", "n", "component_id")
    out = rows.join(own, rows["v"] == own["w"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(
        F.col("id").alias("vec_id"),
        F.when(F.col("id").isNotNull() & F.col("copies").isNotNull(), F.col("n") + F.col("copies") - 1).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
