"""Token counts, encoding, id files and packing next to the libraries and brute force."""

import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from innkeep.llm import bpe, chunks, idfile, packing, tokens

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

ODD = [
    "", " ", "\n", "a", "The cat sat, the dog ran.\nNew  line\t tab", "it's we'll  \n\n x", "Ünïcödé ÀÉ straße, ΑΣ ς",
    "漢字かな 😀 é ​ x", "<|endoftext|>", "a <|endoftext|>b<|startoftext|>", "x\x1c!\x1fy \x85z", "0123 4,5",
    "x" * 9000, "ab" * 4000 + " tail", " \n a\n b", "=" * 5000,
]


def texts_of(seed, n=150):
    rng = random.Random(seed)
    letters = "abcdehtions   \n\t\r.,!'ñéßçЖ漢😀0123́\x1c\x85"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(n)]


@pytest.fixture
def docs(spark):
    """Nulls in every column, repeats, ties, and columns that clash with results."""
    rows = [(i, t, "x", i) for i, t in enumerate(ODD)]
    rows += [(None, "no id", "x", None), (90, None, None, 1), (91, "same", "x", 2), (91, "same", "x", 2), (91, "other", "x", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, length string, n_tokens long").repartition(3)


def plain(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.collect()]


def test_token_counts_are_greedy_longest_matches(spark, docs):
    whole = {*tokens.pieces_of(PIECES), *(bytes([b]) for b in range(256))}
    longest = max(map(len, whole))

    def brute(word):
        n = at = 0
        while at < len(word):
            at += next(k for k in range(min(longest, len(word) - at), 0, -1) if word[at:at + k] in whole)
            n += 1
        return n

    want = []
    for doc_id, text in plain(docs):
        words = text.encode().split()
        want.append((doc_id, len(words), sum(map(len, words)), sum(brute(tokens.SPACE + w) for w in words)))
    got = [tuple(r) for r in tokens.token_counts(docs, PIECES).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert tokens.token_counts(docs.limit(0), PIECES).count() == 0


def test_automaton_with_overlapping_pieces():
    machine = tokens.Automaton([b"abc", b"abcdx", b"bcd", b"cdz", b"d"])
    assert [machine.count(w) for w in (b"", b"abcdx", b"abcdz", b"abcd", b"bcdz")] == [0, 1, 3, 2, 2]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_chunks_give_the_ids_of_whole_texts(path, monkeypatch):
    monkeypatch.setattr(chunks, "MEMO_PIECES", 100)
    library, encoder = Tokenizer.from_file(path), chunks.ChunkEncoder(path)
    for at in range(0, 150, 10):
        some = texts_of(path, 150)[at:at + 10] + ODD
        want = [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(some)] == want


def test_bpe_round_trip(spark, docs):
    library = Tokenizer.from_file(BYTE)
    want = []
    for doc_id, text in plain(docs):
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(decoded)))
    got = [tuple(r) for r in bpe.encode_decode(docs, BYTE).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_transducer_holds_little_and_agrees(monkeypatch):
    codec, library = bpe.codec(BYTE), Tokenizer.from_file(BYTE)
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 32)
    rng = random.Random(3)
    for word in ("".join(rng.choice("etaoinshrdlu") for _ in range(6000)), "the" * 2000, "ab" * 3000):
        data = word.encode()
        parts = list(codec.transduce(data[k:k + 16] for k in range(0, len(data), 16)))
        assert [i for p in parts for i in p] == library.encode(word, add_special_tokens=False).ids
        assert max(len(p) for p in parts) <= codec.lookahead + 48
    assert "".join(codec.decode([[i] for i in library.encode("é漢😀").ids])) == "é漢😀"
    assert "".join(codec.decode([[codec.byte_ids[0xE6]], [codec.byte_ids[0x41]]])) == "�A"


def digests(library, some):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    coded = [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
    return (
        [len(ids) for ids in coded], [sha(",".join(map(str, ids))) for ids in coded],
        [sha(library.decode(ids, skip_special_tokens=False)) for ids in coded],
    )


@pytest.mark.parametrize("block", [16, 50, 1000])
def test_texts_in_blocks(monkeypatch, block):
    """Blocks end anywhere: in words, runs of white space, contractions, special tokens, characters."""
    monkeypatch.setattr(bpe, "BLOCK_CHARS", block)
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 32)
    monkeypatch.setattr(bpe, "TURN_CHARS", 200)
    monkeypatch.setattr(bpe, "MEMO_PIECES", 20)
    rng, library = random.Random(block), Tokenizer.from_file(BYTE)
    some = ODD + texts_of(block, 300)
    for letters in ("aaaa", "aabc''s'r ", "ab <|endoftext|>", "漢字éa😀", " \n"):
        some += ["".join(rng.choice(letters) for _ in range(rng.randint(300, 2500))) for _ in range(20)]
    some += ["a<|endoftext|>" * 200, ("x" * 60 + "<|endoftext|>") * 30, "'" * 3000 + "s", "we're" * 500, "'re" * 700, " " * 3000 + "x"]
    bpe._CODECS.clear()
    assert bpe.round_trips(some, BYTE) == digests(library, some)
    bpe._CODECS.clear()


def test_memory_does_not_grow_with_the_text(monkeypatch):
    for name, value in (("BLOCK_CHARS", 1 << 14), ("TURN_CHARS", 1 << 15), ("MEMO_PIECES", 2000)):
        monkeypatch.setattr(bpe, name, value)
    codec, rng = bpe.Codec(BYTE), random.Random(6)
    words = lambda n: " ".join("".join(rng.choices("etaoinshrdlu", k=9)) for _ in range(n))

    def peak(text):
        tracemalloc.start()
        n = sum(len(ids) for _, ids, _, _ in codec.encode_parts([text])) // 4
        used = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert n >= len(text) / 8 and max(len(codec.spaced.new), len(codec.spaced.old)) < 2000 + (1 << 15)
        return used

    peak(words(20_000))
    assert peak(words(100_000)) < 1.5 * peak(words(25_000))
    assert peak("x" * 1_000_000) < 40 * (1 << 20)


def test_simple8b_words():
    rng = np.random.default_rng(4)
    for n in (0, 1, 59, 61, 3000):
        for high in (1, 2, 300, 50_000, 1 << 40, 1 << 63):
            ids = rng.integers(0, high, n, dtype=np.uint64)
            words, at, values = idfile.pack(ids)
            assert (idfile.unpack(words, n, at, values) == ids).all()
    assert len(idfile.pack(np.zeros(600, np.uint64))[0]) == 10


def test_id_files_give_back_every_document(spark, docs, tmp_path, monkeypatch):
    library = Tokenizer.from_file(WORD)
    out = idfile.token_id_output(docs, WORD, 1, f"file://{tmp_path}/ids").collect()
    coded = {}
    for doc_id, text in plain(docs):
        ids = library.encode(text, add_special_tokens=False).ids + [1]
        coded.setdefault(doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = {}
    for r in out:
        got.setdefault(r["doc_id"], []).append((r["n_tokens"], r["ids_crc32"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in coded.items()}
    ordered = sorted(out, key=lambda r: r["start"])
    assert [r["start"] for r in ordered] == list(np.cumsum([0] + [r["n_tokens"] for r in ordered])[:-1])
    assert [r["doc_id"] is not None for r in ordered] == [False] + [True] * (len(out) - 1)
    assert sorted(r["doc_id"] for r in ordered[1:]) == [r["doc_id"] for r in ordered[1:]]
    assert idfile.token_id_output(docs.limit(0), WORD, 1).count() == 0


def test_id_writer_over_blocks_and_files(tmp_path, monkeypatch):
    monkeypatch.setattr(idfile, "BLOCK_IDS", 100)
    out = idfile.IdWriter(str(tmp_path / "a.s8b"))
    rng = np.random.default_rng(5)
    docs = [(None if k == 3 else k, rng.integers(0, 50_000, n).astype(np.uint64)) for k, n in enumerate([5, 0, 250, 100, 95, 1000])]
    for doc_id, ids in docs:
        out.add(doc_id, ids)
    out.close()
    got, part = [], []
    for doc_id, ids, n in idfile.read_file(str(tmp_path / "a.s8b")):
        part += ids.tolist()
        if n >= 0:
            got.append((doc_id, part))
            part = []
    assert got == [(i, v.tolist()) for i, v in docs]


def fill(made, capacity):
    assert all(sum(lengths) <= capacity and number > 0 for lengths, number in made)
    got = {}
    for lengths, number in made:
        for x in lengths:
            got[x] = got.get(x, 0) + number
    return got


@pytest.mark.parametrize("seed", range(8))
def test_plan_holds_all_and_is_near_the_bound(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 1024])
    counts = {rng.randint(1, capacity): rng.randint(1, 40) for _ in range(rng.choice([3, 20, 300]))}
    made = packing.plan(counts, capacity)
    assert fill(made, capacity) == counts


def test_dominance_is_optimal_on_small_cases():
    def optimum(items, capacity):
        best = [len(items)]

        def go(k, bins):
            if len(bins) >= best[0]:
                return
            if k == len(items):
                best[0] = len(bins)
                return
            for room in {b for b in bins if b >= items[k]}:
                at = bins.index(room)
                go(k + 1, bins[:at] + [room - items[k]] + bins[at + 1:])
            go(k + 1, bins + [capacity - items[k]])

        go(0, [])
        return best[0]

    rng, worse = random.Random(9), 0
    for _ in range(120):
        items = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 9))), reverse=True)
        counts = {x: items.count(x) for x in items}
        made = packing.plan(counts, 20)
        assert fill(made, 20) == counts
        worse += sum(n for _, n in made) - optimum(items, 20)
    assert worse <= 2


def test_packing(spark, docs):
    library = Tokenizer.from_file(BYTE)
    rows = packing.pack_documents(docs, BYTE, 2, capacity=64).collect()
    want = []
    for doc_id, text in plain(docs):
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        start, stop, k = 0, (len(ids) - 1) % 64 + 1, 0
        while start < len(ids):
            want.append((doc_id, k, start, stop - start, zlib.crc32(np.array(ids[start:stop], "<u4").tobytes())))
            start, stop, k = stop, stop + 64, k + 1
    got = [tuple(r)[:5] for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack_documents(docs.limit(0), BYTE, 2).count() == 0


def test_texts_out_of_arrow_without_scalars():
    import pyarrow as pa
    from innkeep.llm import chunks

    words = ["", "a", "é", "\x00", "日本 語", "x" * 5000]
    text = pa.array(["before", *words])[1:]  # a slice
    assert chunks._listed(text) == words == text.to_pylist()
    assert all(type(w) is str for w in chunks._listed(text.dictionary_encode().dictionary)) and chunks._listed(text[:0]) == []
