"""What the operators share: shipping the package, written tables, blocks, components."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from innkeep.session import scratch_path

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application.

    Tasks import their functions by name, so that what a worker process keeps
    (vocabularies, memos) lives as long as the process.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("innkeep", os.path.relpath(path, top)))
    path = os.path.join(tempfile.mkdtemp(prefix="innkeep-code-"), "innkeep_code.zip")
    with open(path, "wb") as f:
        f.write(buffer.getvalue())
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: no later job, and no
    lost executor, makes the rows anew."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_once(df: DataFrame, label: str) -> tuple[DataFrame, Callable[[], None]]:
    """``written``, and what deletes the files once nothing reads them any more."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)

    def drop() -> None:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)

    return spark.read.schema(df.schema).parquet(path), drop


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone; a null text is an empty one."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )


def arrow_map(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    ship_package(df.sparkSession)
    return df.mapInArrow(f, schema)


def batches(columns: dict[str, Iterable], schema: pa.Schema) -> pa.RecordBatch:
    """A batch of the given columns, each an array or a list."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=schema.field(n).type) for n, c in columns.items()],
        schema=schema,
    )


def sliced(batch: pa.RecordBatch, text: str = "text", most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of a bounded text size (a slice has one row at least)."""
    sizes = np.asarray(pc.binary_length(batch.column(text)).fill_null(0).cast(pa.int64()))
    begin, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > most:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += n
    if begin < batch.num_rows:
        yield batch.slice(begin)


# ---- places in an order ----------------------------------------------------------


def placed(rows: DataFrame, order: list[Column], group: str | None = None) -> DataFrame:
    """The rows, written, with ``_part`` (the range a task held), ``_k`` (the place in
    it) and ``_at`` (the place from 0 in the whole order, of the group if one is given).

    Rows are dealt to ranges of the order, however many share a key: the last key is
    the row's number in its file, so identical rows are split too. A task numbers its
    own range; what lies before it is a sum over one count per range and group. Of a
    group, ``order`` must begin with the group, which must not be null. ``rows`` must
    be read from files.
    """
    keys = [*order, F.asc("_row")]
    sorted_ = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys)
    sorted_ = sorted_.sortWithinPartitions(*keys).drop("_row")
    kinds = to_arrow_schema(rows.schema).append(pa.field("_part", pa.int32())).append(pa.field("_k", pa.int64()))

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, last = TaskContext.get().partitionId(), 0, None
        for batch in stream:
            n = batch.num_rows
            if not n:
                continue
            k = np.arange(n)
            if group:
                names = batch.column(group).to_numpy(zero_copy_only=False)
                first = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
                if names[0] != last:
                    seen = 0
                k -= np.repeat(first, np.diff(np.append(first, n)))
                run = first[1] if len(first) > 1 else n
                k[:run] += seen
                last = names[-1]
            else:
                k += seen
            seen = int(k[-1]) + 1
            columns = [c.cast(f.type) for c, f in zip(batch.columns, kinds)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(n, part, np.int32)), pa.array(k)], schema=kinds)

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    numbered = written(arrow_map(sorted_, task, f"{ddl}, _part int, _k long"), "placed")
    by = [group] if group else []
    sizes = numbered.groupBy(*by, "_part").agg(F.max("_k").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*by, "_part", F.coalesce(F.sum(F.col("_n") + 1).over(before), F.lit(0)).alias("_base"))
    return numbered.join(offsets, [*by, "_part"]).select(
        *rows.columns, "_part", "_k", (F.col("_base") + F.col("_k")).alias("_at")
    )


# ---- look-ups with hot keys ---------------------------------------------------------

# A key with more than one row in so many is looked up by broadcast; there are fewer such keys than this.
HOT_SHARE = 1000


def look_up(rows: DataFrame, key: str, found: DataFrame) -> DataFrame:
    """The rows with the columns that ``found`` (one row per key) has for their key, null
    where it has none.

    Of a hot key all rows would meet in one task. Fewer than ``HOT_SHARE`` keys can
    have more than one row in ``HOT_SHARE``; what is found for these is broadcast, and
    their rows stay where they are. ``rows`` must be read from files: they are read
    for the counts, and by each of the two ways.
    """
    total = rows.count()
    hot = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") > total // HOT_SHARE) & F.col(key).isNotNull())
    hot = written(hot.select(F.col(key).alias("_hot")), "hot-keys")
    few = F.broadcast(hot)  # fewer than HOT_SHARE rows
    others = [c for c in found.columns if c != key]
    named = found.select(F.col(key).alias("_key"), *others)
    many = rows.join(few, rows[key] == hot["_hot"], "left_semi").join(
        F.broadcast(named.join(few, named["_key"] == hot["_hot"], "left_semi")), F.col(key) == F.col("_key"), "left"
    )
    rest = rows.join(few, rows[key] == hot["_hot"], "left_anti").join(named, F.col(key) == F.col("_key"), "left")
    return many.drop("_key").unionByName(rest.drop("_key"))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names like these that the frame has no column of."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


# ---- buckets in blocks ----------------------------------------------------------

# Rows of one bucket that meet in a task: at most twice as many.
BLOCK_ROWS = 2048


def in_blocks(rows: DataFrame, keys: list[str], row_id: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows laid out so that any two rows of a bucket meet in some task exactly once.

    Adds ``_i <= _j`` (the two blocks that meet) and ``_side`` (the block of the
    row). Buckets of one row go. A bucket of more than ``block_rows`` rows is
    dealt by a hash of the row's id to blocks of about that size, and each pair of
    blocks is a unit of work of its own, so a hot bucket is spread over many
    tasks. No pair of rows is written out. Null keys meet nothing.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    blocks = F.ceil(F.col("_n") / F.lit(block_rows)).cast("int")
    sized = rows.join(sizes.withColumn("_blocks", blocks).drop("_n"), keys)
    side = F.pmod(F.xxhash64(F.col(row_id), F.lit(17)), F.col("_blocks")).cast("int")
    # Among several blocks, the work on pairs of different blocks includes no
    # pair within a block; that is the work of (i, i).
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    return (
        sized.withColumn("_side", side).withColumn("_other", other)
        .withColumn("_i", F.least("_side", "_other")).withColumn("_j", F.greatest("_side", "_other"))
        .drop("_blocks", "_other")
    )


def by_block(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Each unit of work whole in one task and in one piece."""
    unit = [*keys, "_i", "_j"]
    return rows.repartition(*unit).sortWithinPartitions(*unit)


def runs(stream: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[pa.RecordBatch]]:
    """Successive runs of equal keys; a list of slices each, across batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in stream:
        if not batch.num_rows:
            continue
        columns = [np.asarray(batch.column(k).to_numpy(zero_copy_only=False)) for k in keys]
        differs = np.zeros(batch.num_rows, bool)
        for c in columns:
            differs[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        if last is not None and first != last:
            yield held
            held = []
        bounds = [0, *np.flatnonzero(differs).tolist(), batch.num_rows]
        for n, (a, b) in enumerate(zip(bounds, bounds[1:])):
            if n and held:
                yield held
                held = []
            held.append(batch.slice(a, b - a))
        last = tuple(c[-1] for c in columns)
    if held:
        yield held


# ---- connected components --------------------------------------------------------


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For positions 0..n-1 and links between them, the smallest position of each
    one's component (minimum labels with pointer jumping)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def components(edges: DataFrame) -> DataFrame:
    """``id``, ``component_id`` (the smallest id reachable) of all that have a link.

    ``edges`` has two long columns ``a``, ``b``. Alternating large-star and
    small-star steps: each keeps the components and moves links to smaller ids;
    both are a minimum per id and a join. A hot id is combined before the shuffle
    in the minimum, and split by adaptive skew handling in the join. Each round is
    written, so that the plan does not grow and lost executors cost one round; the
    files of the round before are deleted then.
    """
    def undirected(e: DataFrame) -> DataFrame:
        return e.where("a <> b").selectExpr("greatest(a, b) as a", "least(a, b) as b").distinct()

    now, drop_now = written_once(undirected(edges.select("a", "b").dropna()), "links")
    while True:
        # Large star: larger neighbours of u go to the smallest of u and its neighbours.
        both = now.unionByName(now.selectExpr("b as a", "a as b"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a as u", "least(a, m) as m")
        large = both.join(low, both["a"] == low["u"]).where("b > a").selectExpr("b as a", "m as b")
        large, drop_large = written_once(undirected(large), "links")
        # Small star: smaller neighbours of u, and u, go to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        moved = large.join(low.where("n > 1").selectExpr("a as u", "m"), large["a"] == F.col("u"), "left")
        small = moved.where("m is null or m = b").select("a", "b").unionByName(
            moved.where("b > m").selectExpr("b as a", "m as b")
        )
        small, drop_small = written_once(undirected(small), "links")
        drop_now()
        drop_large()
        # Stars remain: one link per id, and no centre is itself linked to a smaller id.
        state = small.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("b").alias("b"))
        left = state.select(F.col("b").alias("c")).distinct()
        crooked = state.join(left, state["a"] == left["c"], "left").where("n > 1 or c is not null")
        if crooked.isEmpty():
            return small.selectExpr("a as id", "b as component_id")
        now, drop_now = small, drop_small
