"""Importance resampling towards a target: hashed word runs, gains, Gumbel top-k.

A slice of texts becomes one array of word numbers by Arrow kernels; shifted word
numbers of one document are its word pairs. Only distinct words and distinct pairs
are hashed; what a document has is taken by number and added up per document.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeep.llm.common import arrow_map, batches, placed, sliced, texts, written

BUCKETS = 10_000
SHARE = 25  # percent of the documents that may be drawn
LEAST_WORDS = 20
SEED = 7
PART_CHARS = 4 << 20  # of one text that are taken apart at a time

# What is no part of a word, once A-Z are lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SEPARATOR = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_LAST_WORD = re.compile(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\Z")

_COUNTS = pa.schema([("bucket", pa.int32()), ("raw", pa.int64()), ("target", pa.int64())])
_SCORED = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64()), ("score", pa.int64()),
])


def _parts(text: str) -> Iterator[tuple[str, bool]]:
    """A long text in parts; each but the first begins with the last word of those
    before (and says so), so that no pair of neighbours is lost."""
    at, carried = 0, ""
    while at < len(text):
        gap = _SEPARATOR.search(text, at + PART_CHARS) if len(text) - at > PART_CHARS else None
        end = gap.start() if gap else len(text)
        part = carried + text[at:end]
        yield part, bool(carried)
        last = _LAST_WORD.search(part) if gap else None
        carried, at = last.group(1) if last else "", end


class Features:
    """The buckets of all words and pairs of some texts, each with its text's place."""

    def __init__(self, text: pa.Array) -> None:
        owner, skip, text = self._cut_long(text)
        lists = pc.split_pattern_regex(pc.ascii_lower(text), pattern=SEPARATORS)
        words = pc.list_flatten(lists).dictionary_encode()
        place = np.repeat(np.arange(len(text)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        index = words.indices.to_numpy().astype(np.int64)
        said = words.dictionary.cast(pa.binary()).to_pylist()
        nothing = said.index(b"") if b"" in said else -1
        place, index = place[index != nothing], index[index != nothing]

        crc = [zlib.crc32(w) for w in said]
        after = [b" " + w for w in said]
        v = max(1, len(said))
        same = place[1:] == place[:-1]
        pairs = pa.array(index[:-1][same] * v + index[1:][same]).dictionary_encode()
        distinct = pairs.dictionary.to_numpy()
        left, right = (distinct // v).tolist(), (distinct % v).tolist()
        crc_pairs = [zlib.crc32(after[b], crc[a]) for a, b in zip(left, right)]

        first = np.append(True, ~same)[:len(index)]
        own = ~(first & skip[place])  # the word carried over from the part before counts once
        self.rows = len(self.sizes)
        self.words = np.bincount(owner[place[own]], minlength=self.rows)
        self.at = np.concatenate([owner[place[own]], owner[place[1:][same]]])
        bucket = lambda codes: (np.array(codes, np.uint32) % np.uint32(BUCKETS)).astype(np.int32)
        self.buckets = np.concatenate([
            bucket(crc).take(index[own]), bucket(crc_pairs).take(pairs.indices.to_numpy()),
        ])

    def _cut_long(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        self.sizes = pc.binary_length(text).to_numpy(zero_copy_only=False)
        if not len(self.sizes) or self.sizes.max() <= PART_CHARS:
            return np.arange(len(text)), np.zeros(len(text), bool), text
        parts = [list(_parts(t)) or [("", False)] for t in text.to_pylist()]
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        skip = np.array([carried for p in parts for _, carried in p])
        return owner, skip, pa.array([x for p in parts for x, _ in p], pa.string())

    def counts(self) -> np.ndarray:
        return np.bincount(self.buckets, minlength=BUCKETS)

    def totals(self, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of features and sum of their gains, per text."""
        n = np.bincount(self.at, minlength=self.rows)
        return n, np.bincount(self.at, weights=gains.take(self.buckets), minlength=self.rows).astype(np.int64)


def _count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per bucket and task."""
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in stream:
        for side, total in ((True, target), (False, raw)):
            some = batch.filter(pc.equal(batch.column("is_target"), side))
            for part in sliced(some) if some.num_rows else ():
                total += Features(part.column("text")).counts()
    seen = np.flatnonzero(raw + target)
    yield batches({"bucket": pa.array(seen, pa.int32()), "raw": raw[seen], "target": target[seen]}, _COUNTS)


def gains(docs: DataFrame, target: DataFrame, target_text: str = "text") -> np.ndarray:
    """Per bucket, the floored thousandfold logarithm of how much likelier the target
    has it than all documents. One pass over both; the driver gets two numbers a bucket."""
    target = target.withColumn("_none", F.lit(None).cast("long"))
    both = texts(docs).withColumn("is_target", F.lit(False)).unionByName(
        texts(target, "_none", target_text).withColumn("is_target", F.lit(True))
    )
    counted = arrow_map(both.drop("doc_id"), _count, "bucket int, raw long, target long")
    s, t = [0] * BUCKETS, [0] * BUCKETS
    for r in counted.groupBy("bucket").agg(F.sum("raw").alias("s"), F.sum("target").alias("t")).collect():
        s[r["bucket"]], t[r["bucket"]] = r["s"], r["t"]
    all_s, all_t = float(sum(s) + BUCKETS), float(sum(t) + BUCKETS)
    return np.array([
        math.floor(1000.0 * math.log((float(b) + 1.0) * all_s / ((float(a) + 1.0) * all_t))) for a, b in zip(s, t)
    ], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Thousandfold Gumbel noise from the id, the same in every run."""
    said = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(said.encode()).hexdigest()[:8], 16)
    return math.floor(-1000.0 * math.log(-math.log((h + 0.5) / 4294967296.0)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score``, a row per row."""

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in sliced(batch):
                found = Features(part.column("text"))
                n, total = found.totals(gain)
                weight = total // np.maximum(n, 1)
                drawn = np.array([noise(i, seed) for i in part.column("doc_id").to_pylist()], np.int64)
                yield batches({
                    "doc_id": part.column("doc_id"), "n_words": pa.array(found.words), "n_features": pa.array(n),
                    "weight": pa.array(weight), "score": pa.array(weight + drawn),
                }, _SCORED)

    return arrow_map(texts(docs), task, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(
    docs: DataFrame, target: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS, seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank, n_words``, a row per row.

    ``share`` percent of the documents with ``least_words`` words are drawn, those of
    the highest scores (weight and Gumbel noise), ties to smaller doc_id; ``rank``
    counts them from 1 and is null elsewhere. Null texts, of documents or target,
    are empty: no features, weight 0. An empty target prefers nothing but what is
    rare. A row without doc_id draws by an empty id and comes last among ties.
    Repeated rows draw alike and have a rank each. An empty table gives no rows.
    Other columns are ignored.
    """
    rows = written(scored(docs, gains(docs, target), seed), "scored")
    fit = F.col("n_words") >= least_words
    k = share * rows.where(fit).count() // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    ranked = placed(rows.where(fit), order)
    rank = F.when(F.col("_at") < k, F.col("_at") + 1)
    names = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*names, rank.alias("rank"), "n_words").unionByName(
        rows.where(~fit).select(*names, F.lit(None).cast("long").alias("rank"), "n_words")
    )
