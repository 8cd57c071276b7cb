"""Exact top-k search by inner product with a vector-approximation file.

The file has one byte a component: the cell, of 256 between the least and greatest
value of its dimension, that the component lies in. Cells bound a score from both
sides. One scan of the cells gives each query the vectors that may be among its
best; the k with the best lower bounds are read exactly, and then only those whose
upper bound reaches the k-th exact score, until nothing unread can.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from innkeep.llm.common import arrow_map, batches, ship_package, written

SCALE = 1024  # a component x becomes floor(SCALE * x)
CELLS = 256
# Of one unit of work: queries, and vectors (a byte a component).
QUERY_ROWS, VECTOR_ROWS = 2048, 1 << 16
LEAST_GROUPS = 8  # of vectors, once a table has some thousand
STEP = 1 << 21  # bounds worked out at a time
LARGEST = float(1 << 63)
_EXACT = float(1 << 53)

_BOUNDS = pa.schema([("dim", pa.int32()), ("at", pa.int32()), ("low", pa.float64()), ("high", pa.float64())])
_FILE = pa.schema([("rep", pa.int64()), ("code", pa.binary())])
_MAYBE = pa.schema([("query_id", pa.int64()), ("rep", pa.int64()), ("low", pa.float64()), ("high", pa.float64())])
_SCORES = pa.schema([("query_id", pa.int64()), ("rep", pa.int64()), ("score", pa.int64()), ("over", pa.bool_())])


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id``, ``v`` (whole numbers, as doubles that hold them exactly): rows with an id
    and finite components only, each once."""
    x = F.transform(F.col("v"), lambda c: c.cast("double") * SCALE)
    # To the next whole number below; a double from 2^52 on is whole. -0.0 is 0.0.
    floor = lambda c: F.when(F.abs(c) < F.lit(2.0**52), F.floor(c).cast("double")).otherwise(c) + F.lit(0.0)
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vec_col].alias("v"))
    rows = rows.where("id is not null and v is not null and size(v) > 0").where(finite)
    return rows.select("id", F.transform(x, floor).alias("v")).distinct()


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(len(column), -1)


class Cells:
    """The cells of one number of dimensions: where they begin and how wide they are."""

    def __init__(self, low: np.ndarray, high: np.ndarray) -> None:
        self.low, self.width = low, (high - low) / (CELLS - 1)

    def codes(self, v: np.ndarray) -> np.ndarray:
        with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
            at = np.floor((v - self.low) / self.width)
        at = np.clip(np.nan_to_num(at, nan=0.0, posinf=CELLS - 1, neginf=0.0), 0, CELLS - 1).astype(np.uint8)
        # What rounding has put on the wrong side of an edge goes to the next cell.
        at -= (at > 0) & (v < self.low + at * self.width)
        at += (at < CELLS - 1) & (v > self.low + (at + 1.0) * self.width)
        return at

    def bounds(self, queries: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores of queries with what lies in the cells,
        widened by what rounding can do."""
        weight = queries * self.width
        middle = weight @ codes.T.astype(np.float64) + (queries @ self.low)[:, None]
        largest = np.maximum(np.abs(self.low), np.abs(self.low + CELLS * self.width))
        slip = ((np.abs(queries) @ largest) * (2 * len(self.low) + 16) * 2.0**-50)[:, None]
        return middle + np.minimum(weight, 0).sum(axis=1)[:, None] - slip, middle + np.maximum(weight, 0).sum(axis=1)[:, None] + slip


def inner(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact inner products, row by row, of whole numbers in doubles; and which of them
    are no 64-bit integers (held to the nearest)."""
    with np.errstate(over="ignore"):
        size = np.einsum("ij,ij->i", np.abs(a), np.abs(b))
    scores, over = np.zeros(len(a), np.int64), np.zeros(len(a), bool)
    small = size < _EXACT  # no partial sum is rounded
    scores[small] = np.einsum("ij,ij->i", a[small], b[small]).astype(np.int64)
    for r in np.flatnonzero(~small).tolist():
        s = sum(int(x) * int(y) for x, y in zip(a[r].tolist(), b[r].tolist()))
        over[r] = not -(1 << 63) <= s < 1 << 63
        scores[r] = max(-(1 << 63), min((1 << 63) - 1, s))
    return scores, over


def _extent(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least and greatest value of each dimension in a task."""
    seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in stream:
        sizes = np.asarray(batch.column("dim"))
        for dim in np.unique(sizes).tolist():
            v = matrix(batch.column("v").take(pa.array(np.flatnonzero(sizes == dim))))
            low, high = seen.get(dim, (v[0], v[0]))
            seen[dim] = np.minimum(low, v.min(axis=0)), np.maximum(high, v.max(axis=0))
    for dim, (low, high) in seen.items():
        yield batches({"dim": np.full(dim, dim, np.int32), "at": np.arange(dim, dtype=np.int32), "low": low, "high": high}, _BOUNDS)


def _first(df: DataFrame, by: str, order: list, k: int) -> DataFrame:
    """The first k rows of each ``by``; a task sends no more than k of them on."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("_rn") <= k)


def _scored(pairs: DataFrame, classes: DataFrame, queries: DataFrame) -> DataFrame:
    """Exact scores of (query, class) pairs; this is where exact vectors are read."""

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sizes = np.asarray(part.column("dim"))
                for dim in np.unique(sizes).tolist():
                    some = part.take(pa.array(np.flatnonzero(sizes == dim)))
                    scores, over = inner(matrix(some.column("qv")), matrix(some.column("cv")))
                    yield batches({
                        "query_id": some.column("query_id"), "rep": some.column("rep"), "score": scores, "over": pa.array(over),
                    }, _SCORES)

    both = pairs.select("query_id", "rep").join(
        classes.select(F.col("rep").alias("r"), F.col("v").alias("cv")), F.col("rep") == F.col("r")
    ).join(queries.select("query_id", F.col("v").alias("qv"), "dim"), "query_id")
    return arrow_map(both.select("query_id", "rep", "dim", "qv", "cv"), task, "query_id long, rep long, score long, over boolean")


def top_k(
    vectors: DataFrame, every: int, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
    query_rows: int = QUERY_ROWS, vector_rows: int = VECTOR_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each vector whose id is divisible by
    ``every``, the ``k`` others with the highest inner product, ties to smaller ids.

    Equal vectors are one class, of which only the smallest k + 1 ids can be in a
    result. Groups of ``query_rows`` queries meet groups of ``vector_rows`` classes as
    cells. Bounds are exact at all sizes. A score that is in the result and fits in no
    64-bit integer is an error (``does not fit``), and so is a component whose
    thousandfold is not finite.

    Rows without id, and vectors that are null, empty or hold a null or non-finite
    component, take no part. Equal rows count once. If several vectors have one id,
    each is a candidate, and the query is the smallest of them; a query's own id is
    never its candidate. All vectors have one length; a query meets those of its own
    length only. An empty table gives no rows. Other columns are ignored.
    """
    ship_package(vectors.sparkSession)
    # Hot vectors: a task sends the smallest k + 1 ids of each on, whatever their number.
    few = _first(usable(vectors, id_col, vec_col), "v", [F.asc("id")], k + 1)
    # One id may have several vectors, so a class has a number of its own, which the written table keeps.
    classes = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumns({
        "dim": F.size("v"), "rep": F.monotonically_increasing_id(),
    })
    classes = written(classes, "vector-classes")
    queries = usable(vectors, id_col, vec_col).where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    queries = written(queries.select(F.col("id").alias("query_id"), "v", F.size("v").alias("dim")), "queries")
    cells: dict[int, Cells] = {}
    extent = arrow_map(classes.select("v", "dim"), _extent, "dim int, at int, low double, high double")
    found: dict[int, list] = {}
    for r in extent.groupBy("dim", "at").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        found.setdefault(r["dim"], []).append((r["at"], r["low"], r["high"]))
    for dim, sides in found.items():
        _, low, high = map(np.array, zip(*sorted(sides)))
        if not np.isfinite(high - low).all():
            raise OverflowError("a component does not fit: its thousandfold is not finite")
        cells[dim] = Cells(low, high)

    def approximate(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            sizes = np.asarray(batch.column("dim"))
            for dim in np.unique(sizes).tolist():
                some = batch.take(pa.array(np.flatnonzero(sizes == dim)))
                codes = cells[dim].codes(matrix(some.column("v")))
                yield batches({"rep": some.column("rep"), "code": [c.tobytes() for c in codes]}, _FILE)

    file = written(arrow_map(classes.select("rep", "v", "dim"), approximate, "rep long, code binary"), "approximation")
    n = file.count()
    v_groups = max(1, -(-n // vector_rows), min(LEAST_GROUPS, n // 2048))
    q_groups = max(1, -(-queries.count() // query_rows))
    asked = queries.select("query_id", "v", "dim", F.pmod(F.xxhash64("query_id"), F.lit(q_groups)).alias("q"), F.explode(
        F.sequence(F.lit(0), F.lit(v_groups - 1))).alias("g"))
    given = file.select("rep", "code", F.length("code").alias("dim2"), F.pmod("rep", F.lit(v_groups)).cast("int").alias("g2"), F.explode(
        F.sequence(F.lit(0).cast("long"), F.lit(q_groups - 1).cast("long"))).alias("q2"))

    def scan(left: pa.Table, right: pa.Table) -> pa.Table:
        """Of each query the classes that k others of this group are not bound to beat."""
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            ids, exact = left.column("query_id").to_numpy(), matrix(left.column("v"))
            reps = right.column("rep").to_numpy()
            codes = np.frombuffer(b"".join(right.column("code").to_pylist()), np.uint8).reshape(len(reps), -1)
            step = max(1, STEP // len(reps))
            for at in range(0, len(ids), step):
                low, high = cells[exact.shape[1]].bounds(exact[at:at + step], codes)
                for j, query_id in enumerate(ids[at:at + step].tolist()):
                    # k + 1 of them, since the query's own class may be one.
                    least = np.partition(low[j], len(reps) - k - 1)[len(reps) - k - 1] if len(reps) > k + 1 else -np.inf
                    maybe = np.flatnonzero(high[j] >= least)
                    out.append((np.full(len(maybe), query_id), reps[maybe], low[j][maybe], high[j][maybe]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [[], [], [], []]
        return pa.Table.from_batches([batches(dict(zip(_MAYBE.names, columns)), _MAYBE)])

    maybe = written(asked.groupBy("q", "g", "dim").cogroup(given.groupBy("q2", "g2", "dim2")).applyInArrow(
        scan, "query_id long, rep long, low double, high double"
    ), "candidates")
    # First the classes with the best lower bounds are read; k + 1, the query's own may be among them.
    first = _first(maybe, "query_id", [F.desc("low"), F.asc("rep")], k + 1).drop("_rn")
    first = written(_scored(first, classes, queries), "read-first")
    own = queries.join(classes.select("v", F.col("rep").alias("own")), "v").select(F.col("query_id").alias("of"), "own")
    others = first.join(own, (F.col("query_id") == F.col("of")) & (F.col("rep") == F.col("own")), "left_anti")
    # The k-th exact score so far; what is bound to stay below it is never read.
    least = _first(others, "query_id", [F.desc("score"), F.asc("rep")], k).where(F.col("_rn") == k).select(
        F.col("query_id").alias("of"), F.col("score").cast("double").alias("least")
    )
    rest = maybe.join(first.select(F.col("query_id").alias("q"), F.col("rep").alias("r")), (F.col("query_id") == F.col("q")) & (F.col("rep") == F.col("r")), "left_anti")
    rest = rest.join(least, F.col("query_id") == F.col("of"), "left").where("least is null or high >= least")
    scores = first.unionByName(_scored(rest, classes, queries))
    expanded = scores.join(classes.select(F.col("rep").alias("r"), "ids"), F.col("rep") == F.col("r")).select(
        "query_id", "score", "over", F.explode("ids").alias("vec_id")
    ).where("vec_id <> query_id")
    best = _first(expanded, "query_id", [F.desc("score"), F.asc("vec_id")], k)
    fits = F.when(F.col("over"), F.raise_error(F.format_string("the score of query %d with %d does not fit in 64 bits", "query_id", "vec_id")))
    return best.select("query_id", F.col("_rn").alias("rank"), "vec_id", F.coalesce(fits.cast("long"), F.col("score")).alias("score"))
