"""The Merkle manifest and its multiproofs next to a plain tree."""

import hashlib
import random
import zlib

import pytest

from innkeep.llm import merkle

LANGS = ["en", "de", None, "", "zz", "é", "Z"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def said(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k:k + 8])) for k in range(0, len(out[-1]), 8)])
    return out


def proof(tree, at):
    out = []
    for level in tree[:-1]:
        run = range(at // 8 * 8, min(len(level), at // 8 * 8 + 8))
        out.append(([level[p] for p in run if p < at], [level[p] for p in run if p > at]))
        at //= 8
    return out


def brute(rows):
    leaf = lambda r, t: sha("".join(map(said, (r[0], r[1], r[2], r[3], t))))
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r, r[4]), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: x[:3])
        trees[g] = levels([x[2] for x in groups[g]])
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for at, (known, doc_id, h, r) in enumerate(groups[g]):
            steps = proof(trees[g], at) + proof(top, k)
            folded = h
            if known and zlib.crc32(str(doc_id).encode()) % 3 == 0 and r[4] is not None:
                folded = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            for left, right in steps:
                folded = sha("".join(left) + folded + "".join(right))
            out.append((
                r[0], h, trees[g][-1][0], top[-1][0], sha("".join("".join(a + b) for a, b in steps)), folded, folded == top[-1][0],
            ))
    return out


def table(spark, rows):
    """With columns that clash with those of the operator."""
    schema = "doc_id long, source string, lang string, n_chars int, text string"
    names = ["hash", "key", "at", "level", "unit", "n", "_part", "_k", "_row", "root", "leaf"]
    return spark.createDataFrame(
        [(*r, *["x"] * len(names)) for r in rows], f"{schema}, " + ", ".join(f"{c} string" for c in names)
    )


def random_rows(seed, n, langs=LANGS):
    rng = random.Random(seed)
    return [
        (rng.choice([None, rng.randint(0, 3 * n), rng.randint(0, 3 * n)]), rng.choice([None, "", "web"]), rng.choice(langs),
         rng.choice([None, 0, 12]), rng.choice([None, "", "Hello", "plain", "É漢 A", "x" * 5000]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("n,langs", [(1, ["en"]), (8, ["en"]), (9, ["en"]), (65, ["en", None]), (700, LANGS)])
def test_manifest_is_the_plain_tree(spark, n, langs, monkeypatch):
    monkeypatch.setattr(merkle, "UNIT_LEAVES", 20)
    rows = random_rows(n, n, langs)
    rows += rows[:n // 3]  # repeated rows
    got = [tuple(r) for r in merkle.manifest(table(spark, rows).repartition(5)).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)


def test_one_row_many_times_and_many_languages(spark):
    rows = [(7, "s", "en", 1, "Same")] * 300 + [(k, None, f"l{k}", k, "Aa") for k in range(150)]
    made = merkle.manifest(table(spark, rows))
    assert sorted(map(tuple, made.collect()), key=repr) == sorted(brute(rows), key=repr)
    assert not made.where("verified = (folded_root <> root)").count()


def test_no_rows(spark):
    assert merkle.manifest(table(spark, random_rows(1, 1)).limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 7, 8, 64, 65, 1000])
def test_multiproof_is_sufficient_and_minimal(n):
    rng = random.Random(n)
    tree = levels([sha(str(k)) for k in range(n)])
    for size in {1, min(3, n), n}:
        some = sorted(rng.sample(range(n), size))
        need = merkle.missing(some, n)
        assert len(set(need)) == len(need)
        fetched = {(h, p): tree[h][p] for h, p in need}
        leaves = {p: tree[0][p] for p in some}
        paths = merkle.Paths(leaves, n, fetched)
        assert paths.root == tree[-1][0]
        for p in some:
            assert paths.siblings(p) == "".join("".join(a + b) for a, b in proof(tree, p))
            assert paths.fold(p, tree[0][p]) == tree[-1][0]
            assert n == 1 or paths.fold(p, sha("other")) != tree[-1][0]
        for one in need:  # without any of them some path is open
            with pytest.raises(KeyError):
                merkle.Paths(leaves, n, {c: h for c, h in fetched.items() if c != one})
    assert merkle.missing(range(n), n) == []
