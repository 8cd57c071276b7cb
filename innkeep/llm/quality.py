"""Quality selection by importance resampling over hashed n-grams.

Besides the words and pairs of neighbours there are three features beyond the
method: a word said again at once, a line said twice, and the words of a line said
more often. Text that repeats itself has the words of good text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeep.llm.common import arrow_map, batches, free_names, ship_package, sliced, texts, written

BUCKETS = 1 << 16
# A word said again at once; a line said twice; a word of a line said more often.
AGAIN, SECOND_LINE, SAME_LINE = BUCKETS, BUCKETS + 1, BUCKETS + 2
SIZE = BUCKETS + 3
FALSE_REJECT = 5.0  # a good document lost counts as that many bad ones kept
SMOOTHING = 1.0
SEED = 42
SAMPLE_ROWS = 20_000  # labelled rows that the target model and the cut are fitted on
MEMO_WORDS = 200_000

_WORD = re.compile(r"\w+|[^\w\s]+")
_COUNTS = pa.schema([("bucket", pa.int32()), ("raw", pa.int64()), ("target", pa.int64())])
_memo: dict[str, int] = {}


def features(text: str) -> np.ndarray:
    """Buckets of the text's words and pairs of neighbours.

    What repeats itself has the words of good text, so it counts as what it is: a
    word equal to the one before, a line that the text has had, and, where it has
    had it more than once, each of the line's words.
    """
    memo = _memo
    if len(memo) > MEMO_WORDS:
        memo.clear()
    parts, twice, again = [], 0, 0
    had: dict[str, int] = {}
    for line in text.split("\n"):
        words = _WORD.findall(line)
        if not words:
            continue
        before = had[line] = had.get(line, -1) + 1
        if before:
            twice, again = twice + (before == 1), again + len(words) * (before > 1)
            continue
        codes = []
        for w in words:
            c = memo.get(w)
            if c is None:
                c = zlib.crc32(w.encode("utf-8", "surrogatepass"))
                if len(w) <= 64:
                    memo[w] = c
            codes.append(c)
        parts.append(np.array(codes, np.uint64))
    found = []
    for codes in parts:
        same = np.zeros(len(codes), bool)
        same[1:] = codes[1:] == codes[:-1]
        one = codes % np.uint64(BUCKETS)
        one[same] = AGAIN
        pair = (codes[:-1] * np.uint64(0x9E3779B1) + codes[1:] * np.uint64(0x85EBCA77) >> np.uint64(13)) % np.uint64(BUCKETS)
        found += [one, pair[~same[1:]]]
    found += [np.full(twice, SECOND_LINE, np.uint64), np.full(again, SAME_LINE, np.uint64)]
    return np.concatenate(found).astype(np.int64)


def labelled_sample(labels: DataFrame, column: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``label_id``, ``label``: at most ``rows`` labelled ids, by a hash of the id."""
    known = labels.select(labels["doc_id"].cast("long").alias("label_id"), labels[column].cast("int").alias("label")).dropna()
    once = known.groupBy("label_id").agg(F.max("label").alias("label"))
    return once.orderBy(F.xxhash64("label_id"), "label_id").limit(rows)


def _counts(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per bucket and task."""
    raw, target = np.zeros(SIZE, np.int64), np.zeros(SIZE, np.int64)
    for batch in stream:
        for part in sliced(batch):
            for text, label in zip(part.column("text").to_pylist(), part.column("label").to_pylist()):
                c = np.bincount(features(text), minlength=SIZE)
                raw += c
                if label == 1:
                    target += c
    seen = np.flatnonzero(raw)
    yield batches({"bucket": seen, "raw": raw[seen], "target": target[seen]}, _COUNTS)


class Model:
    """Log ratios of the target's and the raw text's bucket probabilities, and the cut."""

    def __init__(self, raw: np.ndarray, target: np.ndarray) -> None:
        share = lambda c: np.log((c + SMOOTHING) / (c.sum() + SMOOTHING * SIZE))
        # Without a target sample the two models are one, and nothing is preferred.
        self.ratio = share(target) - share(raw) if target.sum() else np.zeros(SIZE)
        self.cut = -np.inf

    def weight(self, text: str) -> tuple[float, int]:
        f = features(text)
        return float(self.ratio[f].sum()), len(f)


def gumbel(doc_id: int | None, text: str) -> float:
    """Gumbel noise from the id (of the text, if there is none): the same in every run."""
    said = text if doc_id is None else str(doc_id)
    x = zlib.crc32(said.encode("utf-8", "surrogatepass"), SEED) << 32 | zlib.crc32(said[::-1].encode("utf-8", "surrogatepass"), SEED + 1)
    for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ x >> 30) * m & 0xFFFFFFFFFFFFFFFF
    u = ((x ^ x >> 31) + 0.5) / 2.0**64
    return float(-np.log(-np.log(u)))


def _best_cut(scores: np.ndarray, labels: np.ndarray) -> float:
    """The lowest score to keep with the least loss: the share of good rows below it,
    ``FALSE_REJECT`` times, and of bad rows above it."""
    if not (labels == 1).any() or not (labels == 0).any():
        return -np.inf
    order = np.argsort(scores, kind="stable")
    s, good = scores[order], labels[order] == 1
    bad_below = np.concatenate([[0], np.cumsum(~good)]) / (~good).sum()
    good_kept = 1 - np.concatenate([[0], np.cumsum(good)]) / good.sum()
    fair = np.concatenate([[True], s[1:] > s[:-1], [False]])  # no cut between equal scores
    total = np.where(fair, bad_below + FALSE_REJECT * good_kept, -1)
    return float(s[int(np.argmax(total))])


def kth_largest(df: DataFrame, column: str, k: int, few: int = 4096) -> float:
    """The k-th largest value, exactly, by counting in ever narrower ranges; the
    driver gets ``few`` numbers a round."""
    bounds = df.agg(F.min(column), F.max(column)).first()
    low, high, above = bounds[0], bounds[1], 0
    while low < high:
        inside = df.where((F.col(column) >= low) & (F.col(column) <= high))
        width = (high - low) / few
        at = F.least(F.lit(few - 1), F.floor((F.col(column) - low) / width)) if width > 0 else F.lit(0)
        bins = inside.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("a"), F.max(column).alias("b"))
        for r in sorted(bins.collect(), reverse=True):
            if above + r["n"] >= k:
                break
            above += r["n"]
        if (r["a"], r["b"]) == (low, high):  # as narrow as the numbers allow
            values = [x[0] for x in inside.select(column).distinct().orderBy(F.desc(column)).limit(few).collect()]
            counts = {x[0]: x[1] for x in inside.where(F.col(column) >= values[-1]).groupBy(column).count().collect()}
            for v in values:
                above += counts[v]
                if above >= k:
                    return v
            high = values[-1]
            continue
        low, high = r["a"], r["b"]
    return low


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Raw model from all documents, target model from the good ones of the sample.

    One pass counts both; the sample of labels is bounded and is broadcast. The
    driver gets two numbers a bucket.
    """
    sample = written(labelled_sample(labels, "quality", sample_rows), "quality-labels")
    rows = texts(docs)
    rows = rows.join(F.broadcast(sample), rows["doc_id"] == sample["label_id"], "left").select("doc_id", "text", "label")
    counts = arrow_map(rows, _counts, "bucket int, raw long, target long")
    total = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(SIZE), np.zeros(SIZE)
    for r in total.collect():
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    return Model(raw, target)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, log_weight, n_grams, draw``; ``draw`` is the log weight with Gumbel noise."""
    schema = pa.schema([("doc_id", pa.int64()), ("log_weight", pa.float64()), ("n_grams", pa.int64()), ("draw", pa.float64())])

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in sliced(batch):
                ids, said = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
                weights = [model.weight(t) for t in said]
                yield batches({
                    "doc_id": part.column("doc_id"), "log_weight": [w for w, _ in weights], "n_grams": [n for _, n in weights],
                    "draw": [w + gumbel(i, t) for i, t, (w, _) in zip(ids, said, weights)],
                }, schema)

    return arrow_map(texts(docs), task, "doc_id long, log_weight double, n_grams long, draw double")


def least_draw(rows: DataFrame, labels: DataFrame, model: Model, sample_rows: int = SAMPLE_ROWS) -> float:
    """The least draw selected, of written rows with ``doc_id``, ``log_weight``, ``draw``.

    Gumbel top-k draws k documents without replacement with probabilities in
    proportion to their importance weights. k is the number of documents whose
    weight is not below the cut that best tells the sample's good from its bad rows.
    A tie at the last place selects all that tie.
    """
    sample = labelled_sample(labels, "quality", sample_rows)
    known = rows.join(F.broadcast(sample), rows["doc_id"] == sample["label_id"]).select("label_id", "log_weight", "label")
    known = known.groupBy("label_id").agg(F.min("log_weight").alias("w"), F.max("label").alias("label")).toPandas()
    model.cut = _best_cut(known["w"].to_numpy(float), known["label"].to_numpy())
    k = rows.where(F.col("log_weight") >= float(model.cut)).count()
    return kth_largest(rows, "draw", k) if k else float("inf")


def quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, log_weight, n_grams, draw, selected``, a row per row.

    A null text is an empty one; an empty text has weight zero, like one that is as
    common in the target as in all text. Rows without doc_id draw by their text.
    Repeated rows draw alike. Several labels of one id: the best counts. Without
    labels of both kinds all are selected. An empty table gives no rows. Other
    columns are ignored.
    """
    model = fit(docs, labels, sample_rows)
    rows = written(scored(docs, model), "weights")
    return rows.withColumn("selected", F.col("draw") >= F.lit(least_draw(rows, labels, model, sample_rows)))


def keep_selected(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The selected documents with all their columns. Each is scored once: the documents
    are written with their draw, and those selected are read from there."""
    model = fit(docs, labels, sample_rows)
    ship_package(docs.sparkSession)
    (extra,) = free_names(docs, "scored")

    @F.pandas_udf("log_weight double, draw double")
    def score(ids: pd.Series, said: pd.Series) -> pd.DataFrame:
        weights = [model.weight(t)[0] for t in said]
        noise = [gumbel(None if pd.isna(i) else int(i), t) for i, t in zip(ids, said)]
        return pd.DataFrame({"log_weight": weights, "draw": [w + g for w, g in zip(weights, noise)]}, dtype="float64")

    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = written(docs.withColumn(extra, score(docs["doc_id"].cast("string"), text)), "scored-documents")
    narrow = rows.select(F.col("doc_id").cast("long").alias("doc_id"), f"{extra}.log_weight", f"{extra}.draw")
    last = least_draw(narrow, labels, model, sample_rows)
    return rows.where(F.col(extra)["draw"] >= F.lit(last)).drop(extra)
