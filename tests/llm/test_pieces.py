"""SentencePiece encoding, spans and decoding next to the library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from innkeep.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "\n", "a", "The cat sat, the dog ran.\nNew  line\t tab", "it's we'll  \n\n x", "Ünïcödé ÀÉ straße, ΑΣ ς",
    "漢字かな 😀 é x", "<s>a</s><0x41>", " a", "  a ", "\n\n a\n b", "x\x1c!\x1fy \x85z\x00", "0123 4,5", "x" * 9000,
    "ab" * 4000 + " tail", "=" * 500, " " * 100, "▁a ▁▁b ▁", " ▁", " \n", "a \n b\n", "\n a", "�",
]
LETTERS = "abcdehtions   \n\t\r.,!'ñéßçЖ漢😀0123́\x1c\x85▁"


def texts_of(seed, n=400):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 80))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def encoded(model, some):
    out = [([], [], []) for _ in some]
    for k, (ids, sizes, _, _), source in model.encode_parts(some):
        begins, ends = pieces.spans(np.frombuffer(sizes, "<u4").astype(np.int64), source)
        for mine, more in zip(out[k], (np.frombuffer(ids, "<u4"), begins, ends)):
            mine.extend(more.tolist())
    return out


@pytest.mark.parametrize("part", [pieces.PART_CHARS, 30])
def test_ids_and_spans_are_the_librarys(library, monkeypatch, part):
    monkeypatch.setattr(pieces, "PART_CHARS", part)
    monkeypatch.setattr(pieces, "MEMO_WORDS", 50)
    model = pieces.PieceModel(PATH)
    some = ODD + texts_of(part)
    for text, (ids, begins, ends) in zip(some, encoded(model, some)):
        want = library.encode(text, out_type="proto").pieces
        assert ids == [p.id for p in want]
        assert list(zip(begins, ends)) == [(p.begin, p.end) for p in want]
        assert model.decode(ids) == library.decode(ids)


def test_decoding_any_ids(library):
    model, rng = pieces.piece_model(PATH), random.Random(5)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(262), 259, 28705]) for _ in range(rng.randint(0, 12))]
        assert model.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("rule,options", [
    ("nmt_nfkc", {}), ("identity", {}),
    ("nmt_nfkc", {"remove_extra_whitespaces": True, "add_dummy_prefix": True, "escape_whitespaces": True}),
])
def test_compiled_character_maps(rule, options):
    theirs = sentencepiece.SentencePieceNormalizer(rule_name=rule, **options)
    spec = dict(pieces.fields(dict(pieces.fields(theirs.serialized_model_proto()))[3]))
    rules = pieces.character_map(spec.get(2, b""))
    assert (len(rules) > 100_000) == (rule == "nmt_nfkc")
    mine = pieces.Normalizer(rules, bool(spec.get(3, 1)), bool(spec.get(4, 1)), bool(spec.get(5, 1)))
    for text in ODD + texts_of(8) + ["ﬁ①Ａ　x ｶﾞ", "  ﬁ  x  ", "　　a　 b\t\tc ", "½ é é", "İSTANBUL ß"]:
        normal, source = mine(text)
        want, places = theirs.normalize(text, with_offsets=True)
        assert normal == want
        at_char = {b: k for k, b in enumerate(pieces.byte_starts(text).tolist())}
        assert not normal or [at_char[b] for b in source.tolist()] == list(places)


def test_other_models_are_refused():
    with open(PATH, "rb") as f:
        data = f.read()
    user_defined = b"\x0a\x05\x0a\x01q\x18\x04"  # one more piece, of kind 4
    with pytest.raises(ValueError):
        pieces.PieceModel(data + user_defined)


def test_tables(spark, library):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows = [(k, t, "x", k, "y") for k, t in enumerate(ODD)]
    rows += [(None, "no id", "x", None, "y"), (90, None, None, 1, "y"), (91, "same", "x", 2, "y"), (91, "same", "x", 2, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens long, begins string").repartition(3)
    digests, spans, decoded = [], [], []
    for doc_id, text, *_ in rows:
        want = library.encode(text or "", out_type="proto").pieces
        ids = [p.id for p in want]
        crc = zlib.crc32(np.array([(p.begin, p.end) for p in want], "<u8").tobytes()) if want else 0
        digests.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)), crc))
        spans.append((doc_id, ids, [p.begin for p in want], [p.end for p in want]))
        decoded.append((doc_id, library.decode(ids)))
    as_rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert as_rows(pieces.round_trip(docs, PATH)) == sorted(digests, key=repr)
    coded = pieces.encode(docs, PATH)
    assert as_rows(coded) == sorted(spans, key=repr)
    assert as_rows(pieces.decode(coded, PATH)) == sorted(decoded, key=repr)
    assert pieces.round_trip(docs.limit(0), PATH).count() == pieces.encode(docs.limit(0), PATH).count() == 0
