"""A Merkle manifest of a dataset, with one octopus multiproof per leaf partition.

A tree per group over its leaves in order, and a tree over the groups' roots. Every
``ARITY`` consecutive nodes of a level become one node of the next. A partition of
leaves needs for all its proofs together only those nodes that lie beside the
paths of its leaves and cannot be derived from them: it names their coordinates,
fetches each once, derives all shared interior nodes, and expands from these the
proof of each leaf by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innkeep.llm.common import placed, ship_package, written

ARITY = 8
UNIT_LEAVES = 1 << 15  # leaves that are proven together, at most
TAMPER_EVERY = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_TOP = "top"  # the tree over the groups' roots

Coordinate = tuple[int, int]  # level (leaves are 0), place


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


# ---- one tree --------------------------------------------------------------------


def height(n: int) -> int:
    """Levels above ``n`` leaves; a lone leaf is its own root."""
    h = 0
    while n > 1:
        n, h = -(-n // ARITY), h + 1
    return h


def missing(places: Iterable[int], n: int) -> list[Coordinate]:
    """The fewest nodes that, with the leaves at ``places``, give the whole of all
    their paths to the root of a tree of ``n`` leaves."""
    known, out, level = sorted(set(places)), [], 0
    while n > 1:
        have = set(known)
        parents = sorted({p // ARITY for p in known})
        out += [(level, p) for q in parents for p in range(q * ARITY, min(n, q * ARITY + ARITY)) if p not in have]
        known, n, level = parents, -(-n // ARITY), level + 1
    return out


class Paths:
    """What the leaves at ``places`` and the fetched nodes of a tree give: all nodes on
    the leaves' paths, and beside each the nodes of its run."""

    def __init__(self, leaves: dict[int, str], n: int, fetched: dict[Coordinate, str]) -> None:
        self.height = height(n)
        level, self.beside = dict(leaves), []
        for h in range(self.height):
            runs: dict[int, list[str]] = {}
            for q in {p // ARITY for p in level}:
                run = range(q * ARITY, min(n, q * ARITY + ARITY))
                runs[q] = [level[p] if p in level else fetched[h, p] for p in run]
            self.beside.append(runs)
            level, n = {q: digest("".join(run)) for q, run in runs.items()}, -(-n // ARITY)
        self.root = level[0] if level else None
        self._above: list[dict[int, str]] = [{} for _ in range(self.height + 1)]

    def siblings(self, place: int, level: int = 0) -> str:
        """The siblings on the way up from a node, level by level, left to right."""
        if level == self.height:
            return ""
        q, k = divmod(place, ARITY)
        known = self._above[level + 1]
        if q not in known:
            known[q] = self.siblings(q, level + 1)
        run = self.beside[level][q]
        return "".join(run[:k]) + "".join(run[k + 1:]) + known[q]

    def fold(self, place: int, leaf: str) -> str:
        """The root that follows from a leaf at a place and the siblings on its way."""
        for runs in self.beside:
            place, k = divmod(place, ARITY)
            run = runs[place]
            leaf = digest("".join(run[:k]) + leaf + "".join(run[k + 1:]))
        return leaf


# ---- tables ----------------------------------------------------------------------


def _named(c: Column) -> Column:
    """A field as the digest takes it: its length in bytes and itself, ``-`` for a null."""
    said = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key`` (the group: empty for a null language, else ``=`` and the
    language), ``hash`` and, where the row is one to tamper with, ``changed``."""
    doc_id, source, lang, n_chars, text = (docs[c] for c in FIELDS)
    h = lambda t: F.sha2(F.concat(*map(_named, (doc_id, source, lang, n_chars, t))), 256)
    hit = F.crc32(doc_id.cast("string")) % TAMPER_EVERY == 0
    return docs.select(
        doc_id.cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit("")).alias("key"),
        h(text).alias("hash"),
        F.when(hit, h(F.translate(text.cast("string"), UPPER, LOWER))).alias("changed"),
    )


def tree(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All nodes of the trees of all groups, and their roots.

    ``nodes`` are the leaves ``key, at, hash``, placed from 0 without gaps. The
    nodes come as ``key, level, at, hash``, the roots as ``key, n`` (leaves), ``root``.
    Each level is one group-by over runs of at most ``ARITY`` nodes, so no group is
    ever in one task; it is an eighth of the level below, written, and read for the
    next one. Groups that have come to one node stop.
    """
    sizes = nodes.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    now = nodes.join(sizes, "key").select("key", F.lit(0).alias("level"), "at", "hash", "n", F.col("n").alias("left"))
    now = written(now, "merkle-level")
    levels = [now]
    run = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "hash"))), lambda x: x["hash"]), "")
    tallest = height(now.agg(F.max("n")).first()[0] or 0)
    for level in range(1, tallest + 1):
        above = now.where("left > 1").groupBy("key", "n", "left", F.expr(f"at div {ARITY}").alias("up")).agg(run.alias("run"))
        now = written(above.select(
            "key", F.lit(level).alias("level"), F.col("up").alias("at"), F.sha2("run", 256).alias("hash"), "n",
            F.ceil(F.col("left") / ARITY).alias("left"),
        ), "merkle-level")
        levels.append(now)
    every = levels[0]
    for more in levels[1:]:
        every = every.unionByName(more)
    roots = every.where("left = 1").select("key", "n", F.col("hash").alias("root"))
    return every.select("key", "level", "at", "hash"), roots


def manifest(docs: DataFrame) -> DataFrame:
    """A row per row: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    Leaves are ordered by doc_id within their language, rows without doc_id first,
    equal ids by their digest; groups by language, null first, bytewise. Null fields
    and empty texts have digests of their own (``-`` and ``0:``). Repeated rows are
    leaves each. ``folded_root`` is recomputed from the leaf, after tampering where
    the id is one to tamper with (never without an id), and the original siblings;
    ``verified`` says whether it is the root. Clashing columns are ignored. An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    rows = written(leaves(docs), "leaves")
    order = [F.asc("key"), F.asc_nulls_first("doc_id"), F.asc("hash")]
    # Some leaves of one range and one group are proven together.
    unit = F.concat_ws("/", "_part", (F.col("_k") / UNIT_LEAVES).cast("long"), "key")
    at_place = placed(rows, order, "key").select("doc_id", "key", "hash", "changed", F.col("_at").alias("at"), unit.alias("unit"))
    at_place = written(at_place, "leaves-placed")
    nodes, subroots = tree(at_place.select("key", "at", "hash"))
    top = written(subroots, "subroots").withColumn("top", F.lit(_TOP))
    top = placed(top, [F.asc("top"), F.asc("key")], "top").select("top", "key", "n", "root", F.col("_at").alias("at"))
    top = written(top, "subroots-placed")
    top_nodes, roots = tree(top.select(F.col("top").alias("key"), "at", F.col("root").alias("hash")))
    first = roots.first()
    n_top, root = (first["n"], first["root"]) if first else (0, "")
    ship_package(spark)

    # What each unit lacks, from its bounds alone.
    kinds = "unit string, tree string, level int, at long"

    def wanted(stream):
        for batch in stream:
            out = []
            for u in batch.to_pylist():
                out += [(u["unit"], u["key"], h, p) for h, p in missing(range(u["low"], u["high"] + 1), u["n"])]
                out += [(u["unit"], _TOP, h, p) for h, p in missing([u["top_at"]], n_top)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.string(), pa.int32(), pa.int64()))],
                    names=["unit", "tree", "level", "at"],
                )

    units = at_place.groupBy("unit", "key").agg(F.min("at").alias("low"), F.max("at").alias("high"))
    units = units.join(top.select("key", "n", F.col("at").alias("top_at"), F.col("root").alias("subroot")), "key")
    units = written(units, "units")
    lacking = units.mapInArrow(wanted, kinds)
    every = nodes.unionByName(top_nodes).withColumnRenamed("key", "tree")
    found = lacking.join(every, ["tree", "level", "at"])
    # One row a unit, with what it fetched: some nodes for each level, whatever its size.
    fetched = found.groupBy("unit").agg(F.collect_list(F.struct("tree", "level", "at", "hash")).alias("nodes"))
    given = units.join(fetched, "unit", "left").select("unit", "n", "top_at", "subroot", "nodes")

    def expand(mine: pa.Table, bundle: pa.Table) -> pa.Table:
        u = bundle.to_pylist()[0]
        place, leaf = mine.column("at").to_pylist(), mine.column("hash").to_pylist()
        known: dict[bool, dict[Coordinate, str]] = {True: {}, False: {}}
        for x in u["nodes"] or ():
            known[x["tree"] == _TOP][x["level"], x["at"]] = x["hash"]
        paths = Paths(dict(zip(place, leaf)), u["n"], known[False])
        above = Paths({u["top_at"]: u["subroot"]}, n_top, known[True])
        upper = above.siblings(u["top_at"])
        derived = above.fold(u["top_at"], paths.root)  # of every leaf that is as it was
        proofs = [digest(paths.siblings(p) + upper) for p in place]
        folded = [
            derived if c is None or c == x else above.fold(u["top_at"], paths.fold(p, c))
            for p, x, c in zip(place, leaf, mine.column("changed").to_pylist())
        ]
        n = len(place)
        return pa.table({
            "doc_id": mine.column("doc_id"), "leaf": mine.column("hash"), "subroot": pa.array([u["subroot"]] * n),
            "root": pa.array([root] * n, pa.string()), "proof_sha256": pa.array(proofs, pa.string()),
            "folded_root": pa.array(folded, pa.string()), "verified": pa.array([f == root for f in folded], pa.bool_()),
        })

    return at_place.groupBy("unit").cogroup(given.groupBy("unit")).applyInArrow(
        expand,
        "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    )
