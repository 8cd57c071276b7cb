"""SimHash, embedding near-duplicates and top-k search next to brute force."""

import re

import numpy as np
import pytest
import xxhash

from innkeep.llm import common, simhash, topk, vectors


def groups(n, linked):
    label = list(range(n))

    def find(a):
        while label[a] != a:
            a = label[a]
        return a

    for a in range(n):
        for b in range(n):
            if linked(a, b):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return [find(a) for a in range(n)]


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_every_close_pair_meets_under_some_mask():
    masks = simhash.covering_masks(2)
    assert len(masks) == 7
    for a in range(64):
        for b in range(64):
            assert any(not m >> a & 1 and not m >> b & 1 for m in masks)


def test_simhash(spark):
    base = "the quick brown Fox jumps over the lazy dog and runs away from the big bad wolf in the dark wood".split()
    said = [" ".join(base), " ".join(base).upper(), "", None, " \t\n", "one", "one two", "ÀB c d", "Àb C d", "u0085\u0085x y z"]
    said += [" ".join(base * 30 + [f"w{k}"]) for k in range(12)] + [" ".join(base * 30)] * 3
    rows = [(100 - k, t, "x") for k, t in enumerate(said)] + [(50, "tail of it all", None), (50, "tail of it all", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").repartition(3)
    got = sorted(tuple(r) for r in simhash.near_duplicates(docs).collect())
    rows.sort(key=lambda r: r[0])
    prints = [brute_print(t or "") for _, t, _ in rows]
    roots = groups(len(rows), lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 2)
    assert got == sorted((r[0], format(p, "016x"), rows[g][0]) for r, p, g in zip(rows, prints, roots))
    kept = sorted(r["doc_id"] for r in simhash.keep_one(docs).collect())
    assert kept == sorted({rows[g][0] for g in roots})
    assert simhash.keep_one(docs).columns == docs.columns
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_simhash_rows_without_id(spark):
    docs = spark.createDataFrame([(None, "a b c"), (3, "a b c"), (None, "lone words here")], "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == {(None, 3), (3, 3), (None, None)}
    assert sorted((r["doc_id"] or 0, r["text"]) for r in simhash.keep_one(docs).collect()) == [(0, "lone words here"), (3, "a b c")]


def test_one_row_of_each_group_stays(spark):
    """Whatever ids repeat or lack, and whatever the columns are called."""
    far = ["one two three four five", "rivers run over smooth grey stones", "nothing here is like the others at all", "a b c d e f g"]
    rows = [(1, far[0], "x"), (1, far[1], "x"), (2, far[0], "y"), (None, far[2], "z"), (None, far[2], "z"), (None, far[1], "z"), (5, far[3], "p"), (5, far[3], "p"), (None, None, None)]
    names = "doc_id long, text string, _n string"
    docs = spark.createDataFrame(rows, names).repartition(3)
    for c in ("_lead", "own_id", "OWN_SAID", "lead_id", "number", "fp", "root", "rows", "said", "_hot", "_key", "component_id"):
        docs = docs.withColumn(c, docs["text"])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["text"] or "", r["doc_id"] or 0) for r in kept.collect()) == sorted([(far[0], 1), (far[1], 1), (far[2], 0), (far[3], 5), ("", 0)])
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_look_up_of_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_SHARE", 10)
    rows = [(k % 7, k) for k in range(70)] + [(100, k) for k in range(500)] + [(None, 1), (8, 1)]
    frame = common.written(spark.createDataFrame(rows, "k long, v long"), "rows")
    found = spark.createDataFrame([(k, f"n{k}") for k in [*range(6), 100, 200]], "k long, name string")
    got = sorted(map(tuple, common.look_up(frame, "k", found).collect()), key=repr)
    assert got == sorted([(k, v, f"n{k}" if k in (0, 1, 2, 3, 4, 5, 100) else None) for k, v in rows], key=repr)


def test_blocks_let_every_pair_meet_once(spark):
    rows = spark.createDataFrame([(1, k) for k in range(57)] + [(2, 1), (3, 1), (3, 2), (None, 5), (None, 6)], "b long, id long")
    met = {}
    for r in common.in_blocks(rows, ["b"], "id", block_rows=10).collect():
        met.setdefault((r["b"], r["_i"], r["_j"]), []).append((r["id"], r["_side"]))
    pairs = []
    for (b, i, j), members in met.items():
        for x, s in members:
            for y, t in members:
                if x < y and (i == j or s != t):
                    pairs.append((b, x, y))
    assert sorted(pairs) == [(1, x, y) for x in range(57) for y in range(x + 1, 57)] + [(3, 1, 2)]


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 2), (9, 8), (5, 5), (7, 9)] + [(k, k + 1) for k in range(100, 140)] + [(500, k) for k in range(200, 230)]
    got = {r["id"]: r["component_id"] for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {k: v for k, v in got.items() if k < 100} == {2: 1, 3: 1, 8: 7, 9: 7}
    assert {v for k, v in got.items() if 100 <= k <= 140} == {100}
    assert {v for k, v in got.items() if k >= 200} == {200}


ODD = [
    (None, [1.0] * 8), (1000, None), (1001, []), (1002, [0.0] * 8), (1003, [1.0] * 7 + [None]), (1004, [1.0] * 7 + [float("nan")]),
    (1005, [float("inf")] + [1.0] * 7), (1006, [1.0, 2.0]), (1007, [1e38] * 8), (1008, [1e-38] * 8),
]


@pytest.fixture
def points(spark):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((40, 8))
    near = np.concatenate([base, base[:10] + 0.12 * rng.standard_normal((10, 8)), 3 * base[:5], base[:3], base[:3]]).astype(np.float32)
    rows = [(k, [float(x) for x in v], 1) for k, v in enumerate(near)]
    rows += [(i, v, None) for i, v in ODD] + [rows[4], rows[4]]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int").repartition(3)


def good(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(np.float32(x)) for x in v)


@pytest.mark.parametrize("block_rows", [16_384, 8])
def test_near_vectors(spark, points, block_rows):
    rows, df = points
    usable = [(i, np.float32(v).astype(float)) for i, v, _ in rows if i is not None and good(v) and any(v)]

    def cosine(a, b):
        return float(a / np.abs(a).max() @ (b / np.abs(b).max()) / np.linalg.norm(a / np.abs(a).max()) / np.linalg.norm(b / np.abs(b).max()))

    linked = lambda a, b: a != b and len(usable[a][1]) == len(usable[b][1]) and cosine(usable[a][1], usable[b][1]) >= 0.9
    order = sorted(range(len(usable)), key=lambda k: usable[k][0])
    roots = groups(len(order), lambda a, b: linked(order[a], order[b]) or usable[order[a]][0] == usable[order[b]][0])
    want = {usable[k][0]: (sum(linked(k, m) for m in range(len(usable))), usable[order[g]][0]) for k, g in zip(order, roots)}
    want |= {i: (0, i) for i, v, _ in rows if i is not None and i not in want}
    got = [tuple(r) for r in vectors.near_duplicates(df, block_rows=block_rows).collect()]
    assert len(got) == len(rows)
    assert {r[0]: r[1:3] for r in got if r[0] is not None} == want
    assert all(r[3] == (r[0] == r[2]) for r in got if r[0] is not None)
    assert [r for r in got if r[0] is None] == [(None, 0, None, False)]
    assert vectors.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("block_rows", [16_384, 100])
def test_no_pair_right_at_the_threshold_is_lost(spark, block_rows):
    rng = np.random.default_rng(11)
    base = vectors._unit(rng.standard_normal((1200, 64)))
    away = rng.standard_normal((1200, 64))
    away = vectors._unit(away - np.einsum("ij,ij->i", away, base)[:, None] * base)
    cosine = rng.uniform(0.9001, 0.92, 1200)[:, None]
    pairs = np.concatenate([base, cosine * base + np.sqrt(1 - cosine**2) * away]).astype(np.float32)
    unit = vectors._unit(pairs.astype(np.float64))
    want = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(pairs)], "vec_id long, embedding array<float>").repartition(4)
    more = {"block_rows": block_rows} if block_rows < 16_384 else {}
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_duplicates(df, **more).collect()}
    lost = sum(got[k][0] != want[k] for k in range(2400))
    assert want.min() >= 1 and lost == 0
    assert all(got[k][1] == got[k + 1200][1] == k for k in range(1200))


def test_cells_exclude_what_cannot_link_only():
    rng = np.random.default_rng(12)
    middle = rng.standard_normal((30, 6))
    unit = vectors._unit(np.concatenate([m + 0.2 * rng.standard_normal((40, 6)) for m in middle]))
    pivots = unit[::40]
    cell = (unit @ pivots.T).argmax(axis=1)
    may = vectors.may_meet(unit, cell, pivots, 0.9)
    x, y = np.nonzero(unit @ unit.T >= 0.9)
    assert may[x, cell[y]].all() and (cell[x] != cell[y]).any()
    assert may.mean() < 0.7


def test_codes_estimate_without_bias_and_bound():
    rng = np.random.default_rng(7)
    x = rng.standard_normal((300, 64))
    unit = vectors._unit(np.concatenate([x, x + 0.3 * rng.standard_normal((300, 64))]))
    records = vectors.Codes.packed(unit)
    assert len(records[0]) == 12 + 8 + 64
    codes, left, right = vectors.Codes.read(records, 64), np.arange(300), np.arange(300, 600)
    exact = unit[left] @ unit[right].T
    estimate = codes.signs[left] @ codes.whole[right].T * codes.step[right] / 8 / codes.factor[left][:, None]
    assert abs((estimate - exact).mean()) < 0.01
    assert (np.abs(estimate - exact) <= codes.error[left][:, None] + codes.off[right] / codes.factor[left][:, None]).all()
    assert codes.may_reach(left, right, 0.9)[exact >= 0.9].all()
    a, b = map(np.ravel, np.meshgrid(left, right, indexing="ij"))
    low, high = codes.between(a, b)
    assert (low <= exact.ravel()).all() and (exact.ravel() <= high).all() and (high - low).max() < 0.1
    # A pair is judged alike whatever it is judged with.
    some = vectors.Codes.read([records[k] for k in (5, 305, 17)], 64)
    assert some.between(np.array([0]), np.array([1]))[0] == codes.between(np.array([5]), np.array([305]))[0]


def test_two_vectors_of_one_id(spark):
    """Each has the links of its own vector; the id is one node."""
    rng = np.random.default_rng(3)
    a, b = rng.standard_normal((2, 16))
    near = lambda v: (v + 0.05 * rng.standard_normal(16)).tolist()
    rows = [(7, a.tolist()), (7, b.tolist()), (8, near(a)), (9, near(a)), (3, near(b)), (20, rng.standard_normal(16).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r)[:3] for r in vectors.near_duplicates(df).collect())
    assert got == [(3, 1, 3), (7, 1, 3), (7, 2, 3), (8, 2, 3), (9, 2, 3), (20, 0, 20)]


@pytest.mark.parametrize("dim", [1, 3, 700])
def test_near_vectors_of_other_lengths(spark, dim):
    rng = np.random.default_rng(dim)
    base = rng.standard_normal((30, dim))
    v = np.concatenate([base, base + 0.4 * rng.standard_normal((30, dim)), base + 0.5 * rng.standard_normal((30, dim))])
    unit = vectors._unit(v)
    want = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(3)
    got = {r["vec_id"]: r["n_links"] for r in vectors.near_duplicates(df).collect()}
    assert [got[k] for k in range(90)] == want.tolist()


def best_of(points, every, k):
    """Brute force over (id, whole numbers)."""
    want = []
    first = {}
    for i, v in points:
        first[i] = min(first.get(i, v), v)
    for q, v in first.items():
        if q % every == 0:
            best = sorted((-sum(x * y for x, y in zip(v, w)), i) for i, w in points if i != q and len(w) == len(v))[:k]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(want)


def whole_numbers(v):
    return tuple(int(np.floor(1024 * float(np.float32(x)))) for x in v)


@pytest.mark.parametrize("groups_of", [(2048, 1 << 16), (2, 7)])
def test_top_k(spark, points, groups_of):
    rows, df = points
    df = df.where("vec_id is null or vec_id <> 1007")  # its scores fit in no long
    found = topk.top_k(df, every=5, k=4, query_rows=groups_of[0], vector_rows=groups_of[1]).collect()
    usable = {(i, whole_numbers(v)) for i, v, _ in rows if i is not None and i != 1007 and good(v)}
    assert sorted(tuple(r) for r in found) == best_of(usable, 5, 4)
    assert topk.top_k(df.limit(0), every=5).count() == 0


def test_top_k_of_large_components(spark):
    """True scores as long as they fit in a long, and bounds that hold at that size."""
    rng = np.random.default_rng(13)
    v = np.concatenate([rng.uniform(-1e6, 1e6, (60, 6)), 1e6 + rng.uniform(0, 1e-3, (20, 6)), [[2e5, 0, 0, 0, 0, 0], [3e5, 0, 0, 0, 0, 0], [1, 0, 0, 0, 0, 0]]])
    rows = [(k, [float(x) for x in c]) for k, c in enumerate(v)] + [(7, [5.0] * 6), (7, [-5.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    points = {(i, tuple(int(np.floor(1024 * x)) for x in c)) for i, c in rows}
    assert sorted(map(tuple, topk.top_k(df, every=1, k=5, vector_rows=16).collect())) == best_of(points, 1, 5)


@pytest.mark.parametrize("far", [[1e15, 1e15], [1.7e308, 0.0]])
def test_top_k_says_what_does_not_fit(spark, far):
    df = spark.createDataFrame([(0, far), (1, far), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit"):
        topk.top_k(df, every=2, k=1).collect()


def test_top_k_of_many_copies(spark):
    """Copies and near copies, more than a result has places for."""
    rng = np.random.default_rng(14)
    base = rng.standard_normal(8)
    rows = [(k, base.tolist()) for k in range(400)] + [(400 + k, (base + 1e-3 * rng.standard_normal(8)).tolist()) for k in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    points = {(i, tuple(int(np.floor(1024 * x)) for x in c)) for i, c in rows}
    assert sorted(map(tuple, topk.top_k(df, every=25, k=6, vector_rows=50).collect())) == best_of(points, 25, 6)


def test_cells_bound_every_score():
    rng = np.random.default_rng(15)
    for scale in (1, 1e3, 1e9, 1e14):
        v = np.floor(scale * rng.standard_normal((300, 16)))
        v[:, 3] = 7  # one value alone
        cells = topk.Cells(v.min(axis=0), v.max(axis=0))
        codes = cells.codes(v)
        low, high = cells.bounds(v[:40], codes)
        exact = [[sum(int(a) * int(b) for a, b in zip(q, w)) for w in v] for q in v[:40]]
        assert all(low[i][j] <= exact[i][j] <= high[i][j] for i in range(40) for j in range(300))
        spread = np.array(exact, float).std()
        assert (high - low).mean() < 0.2 * spread


def test_top_k_ties_go_to_smaller_ids(spark):
    df = spark.createDataFrame([(k, [0.5, 0.5]) for k in range(300)], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in topk.top_k(df, every=100, k=3, vector_rows=16).collect()]
    assert sorted(got) == [(q, r + 1, i, 524288) for q in (0, 100, 200) for r, i in enumerate([k for k in range(4) if k != q][:3])]
