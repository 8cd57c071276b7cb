"""Token ids by the tokenizers library, with a memo for the pieces that repeat.

A text is cut before a space or line feed that follows something else than white
space. No token of these vocabularies reaches over such a place, and nothing they
look at does, so the ids of a text are the ids of its pieces, one after the other.
Most pieces repeat, and a repeat costs one look-up. Likewise a run of letters and
the comma or full stop after it are split by the vocabularies' patterns.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# Where a space or line feed follows white space, the longer way is taken.
_RUN = re.compile(r"\s[ \n]")
_CHUNK = re.compile(r"\s*\S+|\s+")
# Python counts these as white space, the vocabularies' patterns do not.
_ODD = re.compile("[\x1c-\x1f]")
# The same for Arrow's kernels, and what else Python takes for white space.
_SPACES = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}][ \n]"
# Text whose lower case is the same for every library.
_LATIN = re.compile("[\x00-\x7fÀ-ÖØ-öø-ÿ]*")
# A word with marks behind it, maybe after a line feed. An apostrophe may begin a contraction, < a special token.
_MARKED = re.compile("(\n?)([^\\W\\d_]+)[!-&(-/:;=?@\\[-`{-~]+")
MEMO_PIECES = 250_000
MEMO_CHARS = 64
WORDS = 200  # in a text for the library

_ENCODERS: dict[tuple[str, int | None], "ChunkEncoder"] = {}


def cut(text: str) -> tuple[list[str], list[str]]:
    """Pieces as they are, and then pieces given by what follows their space, or by all
    of them where they begin with a line feed."""
    if _RUN.search(text) is None:
        spaced = text.replace("\n", " \n").split(" ")
        first = spaced.pop(0)
        return [first] if first else [], spaced
    return [text] if _ODD.search(text) else _CHUNK.findall(text), []


def piece_of(key: str) -> str:
    """The piece of a key of the second list."""
    return key if key[:1] == "\n" else " " + key


def _listed(text: pa.Array) -> list[str]:
    """``to_pylist`` makes a scalar of each text first; this does not."""
    return text.to_numpy(zero_copy_only=False).tolist()


class Memo:
    """What is known of pieces. What has not been used while ``limit`` others came goes."""

    def __init__(self, limit: int | None = None) -> None:
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.limit = limit

    def turn(self) -> None:
        if len(self.new) > (self.limit or MEMO_PIECES):
            self.new, self.old = {}, self.new

    def missing(self, keys: set[str]) -> set[str]:
        """Those of ``keys`` that are not known; known ones are at hand afterwards."""
        new, old = self.new, self.old
        keys = {k for k in keys if k not in new}
        again = {k for k in keys if k in old} if old else set()
        if again:
            new.update(zip(again, map(old.__getitem__, again)))
            keys -= again
        return keys


class ChunkEncoder:
    """Ids as bytes: unsigned, little-endian, 32 bits each."""

    def __init__(self, path: str, memo: int | None = None) -> None:
        # The tasks are the parallel unit; a library thread pool per task is not.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        normal = self.tokenizer.normalizer
        self.folds = normal is not None and normal.normalize_str("AZÀÝ") == "azàý"
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.begins = not suffix
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        marks = [i for t, i in vocabulary.items() if (t.endswith(suffix) if suffix else t.startswith("\u0120"))]
        self.marks = np.zeros(max(vocabulary.values()) + 1, bool) if marks else None
        if marks:
            self.marks[marks] = True
        self.whole, self.spaced = Memo(memo), Memo(memo)

    def _words(self, words: list[str], marks: np.ndarray) -> list[bytes]:
        """Runs of letters, each after a space, some with a comma or full stop behind, in
        one text for many: the library then needs no word numbers. ``marks`` says how
        many tokens of each begin (or end) a word."""
        if not words or self.marks is None:
            return self._ids([" " + w for w in words])
        some = [" " + " ".join(words[at:at + WORDS]) for at in range(0, len(words), WORDS)]
        found = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, "<u4") for e in found])
        at = 4 * np.flatnonzero(self.marks[ids])
        if len(at) != marks.sum():  # letters that the library does not take for such
            return self._ids([" " + w for w in words])
        data = ids.tobytes()
        last = np.cumsum(marks)
        bounds = [*at[last - marks].tolist(), len(data)] if self.begins else [0, *(at[last - 1] + 4).tolist()]
        return [data[a:b] for a, b in zip(bounds, bounds[1:])]

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """One call of the library for all; its word numbers tell the pieces apart."""
        if not pieces:
            return []
        found = self.tokenizer.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found.ids, "<u4").tobytes()
        counts = np.bincount(np.array(found.word_ids, np.int64), minlength=len(pieces))
        ends = (4 * np.cumsum(counts)).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def _learn(self, memo: Memo, fresh: set[str], spaced: bool) -> dict[str, bytes]:
        """Add the ids of what is missing; of what is long, return them instead."""
        words: list[str] = []
        marks: list[int] = []
        others: list[str] = []
        with_mark = 1 if self.begins else 2
        for key in fresh if spaced else ():
            if key.isalpha():
                words.append(key)
                marks.append(1)
            elif key[-1:] in (",", ".") and key[:-1].isalpha():
                words.append(key)
                marks.append(with_mark)
            elif (m := _MARKED.fullmatch(key)) and m.group(2).isalpha() and not (m.group(1) and self.begins):
                words.append(key)
                marks.append(with_mark)
            elif key[:1] == "\n" and not self.begins and key[1:].isalpha():
                words.append(key)
                marks.append(1)
            else:
                others.append(key)
        if not spaced:
            others = list(fresh)
        done = dict(zip(words, self._words(words, np.array(marks, np.int64))))
        done.update(zip(others, self._ids([piece_of(k) for k in others] if spaced else others)))
        long = {k: done.pop(k) for k in fresh if len(k) > MEMO_CHARS}
        memo.new.update(done)
        return long

    def _lowered(self, text: str) -> str:
        """Lower case, where the library makes it anyway: fewer pieces differ."""
        if not _LATIN.fullmatch(text):
            return text
        low = text.lower()
        return text if any(s in low for s in self.specials) else low

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text. Texts are cut and their pieces numbered by Arrow kernels; what
        differs is looked up once, and the ids are taken by number. Texts with spaces
        after white space are cut one by one."""
        text = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not len(text):
            return []
        odd = np.asarray(pc.match_substring_regex(text, _SPACES).to_numpy(zero_copy_only=False), bool)
        out: list[bytes] = [b""] * len(text)
        self.whole.turn()
        self.spaced.turn()
        for rows, some in ((np.flatnonzero(~odd), self._plain), (np.flatnonzero(odd), self._odd)):
            if len(rows):
                for r, ids in zip(rows.tolist(), some(text if len(rows) == len(text) else text.take(pa.array(rows)))):
                    out[r] = ids
        pa.default_memory_pool().release_unused()  # the kernels' arrays of this slice are gone
        return out

    def _plain(self, text: pa.Array) -> list[bytes]:
        if self.folds:
            lowered = pc.ascii_lower(text)
            if pc.any(pc.not_equal(pc.binary_length(text), pc.utf8_length(text))).as_py() or self._hits(lowered):
                lowered = pa.array([self._lowered(t) for t in text.to_pylist()], pa.string())
            text = lowered
        lists = pc.split_pattern(pc.replace_substring(text, "\n", " \n"), " ")
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        pieces = pc.list_flatten(lists).dictionary_encode()
        index = pieces.indices.to_numpy().astype(np.int64)
        starts = np.cumsum(counts) - counts
        # The first piece of a text has no space before it.
        begins = _listed(pc.list_element(lists, 0))
        spaced = _listed(pieces.dictionary)
        index[starts] = len(spaced) + np.arange(len(begins))
        long_whole = self._learn(self.whole, self.whole.missing({k for k in begins if k}), False)
        long_spaced = self._learn(self.spaced, self.spaced.missing(set(spaced)), True)
        w = self.whole.new | long_whole if long_whole else self.whole.new
        s = self.spaced.new | long_spaced if long_spaced else self.spaced.new
        known = [*map(s.__getitem__, spaced), *(w[k] if k else b"" for k in begins)]
        ids = np.frombuffer(b"".join(known), "<u4")
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        taken = sizes[index]
        after = np.cumsum(taken)
        shift = (np.cumsum(sizes) - sizes)[index] - (after - taken)
        data = ids[np.arange(int(after[-1])) + np.repeat(shift, taken)].tobytes()
        bounds = [0, *(4 * after[starts + counts - 1]).tolist()]
        return [data[a:b] for a, b in zip(bounds, bounds[1:])]

    def _hits(self, text: pa.Array) -> bool:
        return any(pc.any(pc.match_substring(text, s)).as_py() for s in self.specials)

    def _odd(self, text: pa.Array) -> list[bytes]:
        said = text.to_pylist()
        both = [cut(self._lowered(t)) for t in said] if self.folds else [cut(t) for t in said]
        whole: set[str] = set()
        spaced: set[str] = set()
        for some, pieces in both:
            whole.update(some)
            spaced.update(pieces)
        long_whole = self._learn(self.whole, self.whole.missing(whole), False)
        long_spaced = self._learn(self.spaced, self.spaced.missing(spaced), True)
        w = self.whole.new | long_whole if long_whole else self.whole.new
        s = self.spaced.new | long_spaced if long_spaced else self.spaced.new
        return [
            b"".join(map(w.__getitem__, some)) + b"".join(map(s.__getitem__, pieces)) for some, pieces in both
        ]


def encoder(path: str, memo: int | None = None) -> ChunkEncoder:
    """One per worker process, vocabulary and size of the memo."""
    if (path, memo) not in _ENCODERS:
        _ENCODERS[path, memo] = ChunkEncoder(path, memo)
    return _ENCODERS[path, memo]
