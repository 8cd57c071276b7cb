"""Importance resampling next to a plain version, and as SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from innkeep.llm import common, resample

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(f):
    return zlib.crc32(f.encode()) % 10_000


def brute(docs, target, least=20, share=25):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, features(text)[1]))
    for text in target:
        t.update(map(bucket, features(text)[1]))
    big_s, big_t = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    gain = [math.floor(1000 * math.log((t[b] + 1) * big_s / ((s[b] + 1) * big_t))) for b in range(10_000)]
    rows, fit = [], []
    for doc_id, text in docs:
        words, all_ = features(text)
        weight = sum(gain[bucket(f)] for f in all_) // len(all_) if all_ else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(all_), weight, score, None, len(words)])
        if len(words) >= least:
            fit.append(rows[-1])
    fit.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for rank, row in enumerate(fit[:share * len(fit) // 100]):
        row[4] = rank + 1
    return [tuple(r) for r in rows]


def texts_of(seed, n):
    rng = random.Random(seed)
    said = ["The", "cat", "Sat", "é漢", "x9", "A", "ÀB", "dog", "ran", "to", "12", "İ"]
    return [
        "".join(rng.choice(said) + rng.choice([" ", ", ", "\n", "--", "\x00", "_", "\x7f "]) for _ in range(rng.choice([0, 1, 19, 20, 21, 60])))
        for _ in range(n)
    ]


@pytest.fixture
def docs(spark):
    rows = [(k, t, "x", 1) for k, t in enumerate(texts_of(1, 300))]
    rows += [(5, rows[5][1], "x", 1)] * 40 + [(None, "one two " * 30, "x", None), (None, None, None, None), (900, "", "x", 2), (900, " ,", "x", 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score string, rank long")
    return frame.withColumns({c: F.lit("x") for c in ("_at", "_part", "_k", "_row", "is_target", "weight")}).repartition(4)


def test_resampling(spark, docs):
    said = texts_of(2, 40) + [None, ""]
    target = spark.createDataFrame([(t, "x") for t in said], "text string, doc_id string")
    path = common.scratch_path(spark, "docs")  # rows in files, as in use
    docs.write.parquet(path)
    docs = spark.read.parquet(path)
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], said)
    got = [tuple(r) for r in resample.resample(docs, target).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, max(r[4] or 0 for r in got) + 1))
    no_target = resample.resample(docs, target.limit(0))
    assert sorted(map(tuple, no_target.collect()), key=repr) == sorted(brute([(r["doc_id"], r["text"]) for r in docs.collect()], []), key=repr)
    assert resample.resample(docs.limit(0), target).count() == 0


@pytest.mark.parametrize("most", [1, 7, 40])
def test_long_texts_in_parts(monkeypatch, most):
    some = texts_of(3, 60) + ["", " ", "a" * 200, "b c " * 50]
    whole = resample.Features(pa.array(some, pa.string()))
    monkeypatch.setattr(resample, "PART_CHARS", most)
    parts = resample.Features(pa.array(some, pa.string()))
    assert whole.words.tolist() == parts.words.tolist() == [len(features(t)[0]) for t in some]
    assert whole.counts().tolist() == parts.counts().tolist()
    gain = np.arange(resample.BUCKETS)
    for a, b in zip(whole.totals(gain), parts.totals(gain)):
        assert a.tolist() == b.tolist()


def test_places_in_an_order(spark):
    rng = random.Random(4)
    rows = [(rng.choice("abc"), rng.randint(0, 5)) for _ in range(500)] + [("hot", 1)] * 700
    frame = common.written(spark.createDataFrame(rows, "g string, v int").repartition(6), "rows")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which would join so few
    try:
        got = common.placed(frame, [F.asc("g"), F.asc("v")], "g").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for g in {r[0] for r in rows}:
        mine = sorted((r["_at"], r["v"]) for r in got if r["g"] == g)
        assert [at for at, _ in mine] == list(range(len(mine)))
        assert [v for _, v in mine] == sorted(v for h, v in rows if h == g)
    # Equal rows are dealt to several tasks.
    assert len({r["_part"] for r in got if r["g"] == "hot"}) > 1
    all_ = common.placed(frame, [F.desc("v"), F.asc("g")]).collect()
    ordered = sorted(all_, key=lambda r: r["_at"])
    assert [r["_at"] for r in ordered] == list(range(len(rows)))
    assert [(-r["v"], r["g"]) for r in ordered] == sorted((-v, g) for g, v in rows)
