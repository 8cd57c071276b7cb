"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeep.llm.common import (
    arrow_map, batches, by_block, components, free_names, in_blocks, local_roots, look_up, runs, sliced, texts, written,
)

BITS = 64
WORDS = 3
RADIUS = 2
SEED = 42  # of XXH64

_PRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("said", pa.int64())])
_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_CHUNK = 1 << 16


def fingerprint(text: str, words: int = WORDS) -> int:
    """The 64-bit SimHash of the text's shingles, each with its number of repeats."""
    w = text.encode("utf-8", "surrogatepass").lower().split()  # A-Z and ASCII white space only
    if not w:
        return 0
    if len(w) < words:
        shingles = [b" ".join(w)]
    elif words == 3:
        shingles = None
    else:
        shingles = [b" ".join(w[i:i + words]) for i in range(len(w) - words + 1)]
    digest, total = xxhash.xxh64_intdigest, 0
    ones = np.zeros(BITS, np.int64)
    n = len(w) - words + 1 if shingles is None else len(shingles)
    for at in range(0, n, _CHUNK):
        if shingles is None:
            part = w[at:at + _CHUNK + 2]
            h = [digest(b"%b %b %b" % s, SEED) for s in zip(part, part[1:], part[2:])]
        else:
            h = [digest(s, SEED) for s in shingles[at:at + _CHUNK]]
        bits = np.unpackbits(np.array(h, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(h)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id``, ``fp`` (the fingerprint's 64 bits as a signed long) and ``said`` (a hash of
    the text), one row per row."""

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in sliced(batch):
                prints = np.array([fingerprint(t, words) for t in part.column("text").to_pylist()], np.uint64)
                yield batches({"doc_id": part.column("doc_id"), "fp": prints.view(np.int64), "said": part.column("said")}, _PRINTS)

    return arrow_map(texts(docs).withColumn("said", F.xxhash64("text")), task, "doc_id long, fp long, said long")


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """2^(radius+1) - 1 masks such that any ``radius`` bits miss some mask altogether.

    Bit i carries a non-zero vector v(i) of radius + 1 binary coordinates, mask a
    (a non-zero vector too) holds the bits with odd <a, v(i)>. For any ``radius``
    bits there is an a orthogonal to all their vectors, since these do not span
    the space: two fingerprints that differ there agree under mask a.
    """
    size = (1 << (radius + 1)) - 1
    return [
        sum(1 << i for i in range(bits) if bin(a & (i % size + 1)).count("1") % 2)
        for a in range(1, size + 1)
    ]


def _near(stream: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links that join the parts of each unit of work, as a spanning star per part."""
    found_a: list[np.ndarray] = []
    found_b: list[np.ndarray] = []
    size = 0
    for run in runs(stream, ["table", "key", "_i", "_j"]):
        if sum(b.num_rows for b in run) < 2:
            continue
        column = lambda c: np.concatenate([b.column(c).to_numpy() for b in run])
        ids, side = column("fp"), column("_side")
        fp = ids.view(np.uint64)
        i, j = run[0].column("_i")[0].as_py(), run[0].column("_j")[0].as_py()
        left = np.arange(len(ids)) if i == j else np.flatnonzero(side == i)
        right = left if i == j else np.flatnonzero(side == j)
        pairs_l, pairs_r = [], []
        for at in range(0, len(left), 256):
            block = left[at:at + 256]
            near = np.bitwise_count(fp[block][:, None] ^ fp[right][None, :]) <= radius
            x, y = np.nonzero(near)
            x, y = block[x], right[y]
            keep = x != y
            pairs_l.append(x[keep])
            pairs_r.append(y[keep])
        x, y = np.concatenate(pairs_l), np.concatenate(pairs_r)
        if not len(x):
            continue
        order = np.argsort(ids, kind="stable")  # the smallest of a part is its centre
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        root = local_roots(len(ids), place[x], place[y])
        moved = np.flatnonzero(root != np.arange(len(ids)))
        found_a.append(ids[order][moved])
        found_b.append(ids[order][root[moved]])
        size += len(moved)
        if size > 100_000:
            yield batches({"a": np.concatenate(found_a), "b": np.concatenate(found_b)}, _EDGES)
            found_a, found_b, size = [], [], 0
    if size:
        yield batches({"a": np.concatenate(found_a), "b": np.concatenate(found_b)}, _EDGES)


def grouped(prints: DataFrame, radius: int) -> DataFrame:
    """``fp``, ``root`` (the smallest fingerprint reachable) and ``rep`` (the smallest doc_id
    of the class): a row for each fingerprint that occurs.

    Documents of one fingerprint are one class and are never paired. The classes
    meet in 2^(radius+1) - 1 tables, one per covering mask, keyed by the masked
    fingerprint; every pair within the radius meets in a table at least. A table's
    bucket is split into blocks (``in_blocks``), and each unit of work returns
    spanning links only.
    """
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    masks = [m - (1 << 64) if m >> 63 else m for m in covering_masks(radius)]
    tables = F.explode(F.array(*[
        F.struct(F.lit(k).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(masks)
    ])).alias("at")
    of_tables = classes.select("fp", tables).select("fp", "at.table", "at.key")
    units = by_block(in_blocks(of_tables, ["table", "key"], "fp"), ["table", "key"])
    edges = arrow_map(units, lambda s: _near(s, radius), "a long, b long")
    found = components(edges)
    named = classes.join(found, classes["fp"] == found["id"], "left")
    return written(named.select("fp", F.coalesce("component_id", "fp").alias("root"), "rep"), "groups")


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``, one row per document row.

    Links go from text to text; a component's name is the smallest doc_id in it.

    A null text is an empty one; an empty text has fingerprint zero and links like
    any other. Repeated rows, and rows that repeat a doc_id, each get a row with the
    component of its own text. A row without doc_id links like any other; where no
    document of a component has an id, its name is null. An empty table gives no
    rows. Other columns are ignored.
    """
    prints = written(fingerprints(docs, words), "fingerprints")
    groups = grouped(prints, radius)
    names = groups.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = written(look_up(groups.select("fp", "root"), "root", names).select("fp", "component_id"), "named")
    out = look_up(prints.select("doc_id", "fp"), "fp", named)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """The documents, one row of each component, with all their columns.

    The row with the smallest doc_id stays, one without doc_id only where no other
    has one; among these the smaller fingerprint, and then the smaller hash of the
    text, decide. Of rows equal in doc_id and text any one stays. So no component is
    lost, whatever ids repeat, and no copy stays.
    """
    prints = written(fingerprints(docs, words), "fingerprints")
    rooted = look_up(prints, "fp", grouped(prints, radius).select("fp", "root"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "said")
    leads = written(rooted.groupBy("root").agg(F.min(order).alias("lead")).select("lead.doc_id", "lead.said"), "leads")
    # How many rows a lead stands for; most for itself alone.
    as_lead = leads.select(F.col("doc_id").alias("_d"), F.col("said").alias("_s"))
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("said") == F.col("_s"))
    sizes = prints.join(as_lead, same, "left_semi").groupBy("doc_id", "said").agg(F.count(F.lit(1)).alias("rows"))
    own_id, own_said, lead_id, lead_said, number = free_names(docs, "own_id", "own_said", "lead_id", "lead_said", "number")
    leads = sizes.select(F.col("doc_id").alias(lead_id), F.col("said").alias(lead_said), F.col("rows").alias(number))
    marked = docs.withColumns({
        own_id: docs["doc_id"].cast("long"), own_said: F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))),
    })
    kept = marked.join(leads, F.col(own_id).eqNullSafe(F.col(lead_id)) & (F.col(own_said) == F.col(lead_said)))
    once = kept.where(F.col(number) == 1)
    again = kept.where(F.col(number) > 1).dropDuplicates([own_id, own_said])
    return once.unionByName(again).drop(own_id, own_said, lead_id, lead_said, number)
