"""Toxicity by a weighted finite-state grammar over clauses."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innkeep.llm.common import arrow_map, batches, components, ship_package, sliced, texts, written

SAMPLE_ROWS = 20_000  # labelled rows that the grammar is fitted on
FOLDS = 5
CANDIDATES = 20_000  # words and stems that may enter the lexicon
CHANCE = 0.05  # of one wrong entry in the lexicon
STEMS = (3, 4, 5, 6, 7, 8)  # lengths of the stems that are tried besides whole words
REPEATS = (1, 2, 3)  # and how often a stem is there: by chance it may be once
PRIOR = 4.0  # imagined documents that hold a context's weight near zero
# Copies in the sample: runs of words, and bands of minima over them. Of pairs of texts
# that share 0.8 of their runs one in 5,000 agrees in no band; of those that share 0.2
# one in ten agrees in some.
RUN_WORDS = 5
BANDS, BAND_ROWS = 12, 3
MEMO_WORDS = 200_000

# Closed classes of words in English, German, French and Spanish.
TARGET = frozenset("you your yours yourself du dich dir dein deine ihr euch tu te toi ton vous votre usted ustedes tú ti tus vosotros".split())
# Others, whom a first person threatens.
THIRD = frozenset("them him her everyone everybody".split())
FIRST = frozenset("i we ich wir je nous yo nosotros".split())
NEGATION = frozenset("not no never isn aren wasn don doesn didn won nicht kein keine nie niemals ne pas jamais aucun nunca jamás ningún".split())
REPORT = frozenset("said says say told wrote claimed quoted sagte sagt schrieb behauptet dit disait écrit dijo dice escribió".split())
THREAT = frozenset("kill hurt destroy murder töten umbringen tuer frapper matar".split())
# Contracted forms too; "ll" is what words are cut to at the apostrophe.
INTENT = frozenset("will ll shall gonna gunna imma finna going werde werd werden vais allons voy vamos".split())
# Used where there are no labels to learn from.
SEED_INSULTS = frozenset("idiot moron stupid loser scum trampel dummkopf imbécile idiota estúpido".split())
SEED_WEIGHT = 2.0
THREAT_WEIGHT = 1.0
# A threat's words that the sample does not show in such a context are no threat.
DOUBT = -2.0
REACH = 4  # words between a threat and its target
CALL_REACH = 2  # between a call to it and the target

_WORD = re.compile(r"[^\W\d_]+")
_PART = re.compile(r"[^\W\d_]+|[.!?;:\n]|[\"“”«»„]")
_FEATURES = pa.schema([("feature", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
_FOUND = pa.schema([("found", pa.list_(pa.string())), ("label", pa.int32())])
_KEYS = pa.schema([("id", pa.int64()), ("label", pa.int32()), ("band", pa.int32()), ("key", pa.int64())])
_CONTEXTS = pa.schema([("context", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])


# ---- transducers ------------------------------------------------------------------

# Symbols: I insult, H threat, T target, P third person, S first person, N negation,
# R reported speech, W intent, Q quotation mark, E end of a clause, O any other word. A transducer is a start
# state, a step and an output: for state and symbol, a mark or "".


class Window:
    """A symbol marks the ``reach`` words after it in the clause."""

    def __init__(self, symbol: str, mark: str, reach: int) -> None:
        self.symbol, self.mark, self.reach, self.start = symbol, mark, reach, 0

    def step(self, state: int, symbol: str) -> int:
        if symbol == "E":
            return 0
        return self.reach if symbol == self.symbol else max(0, state - 1)

    def output(self, state: int, symbol: str) -> str:
        return self.mark if state and symbol in "IH" else ""


class Reported:
    """A verb of saying marks the rest of its clause, quotation marks what is between."""

    start = 0

    def step(self, state: int, symbol: str) -> int:
        if symbol == "R":
            return state | 1
        if symbol == "Q":
            return state ^ 2
        return state & 2 if symbol == "E" else state

    def output(self, state: int, symbol: str) -> str:
        return "reported " if state and symbol in "IH" else ""


class Match:
    """An insult matches by itself; a threat needs intent before it and a target in its
    clause. One without a target so far is open, and the next target answers it; a
    third person does so near it, if a first person has the intent. A threat that
    begins its clause is a call to it, and open as well.

    The state is whether there was intent, whether there was a target, the words that
    an open threat's target is near for (-1: it would be far, 0: none is open), whether
    there was a first person, and whether the clause has had a word."""

    start = (0, 0, 0, 0, 0)

    def step(self, state: tuple, symbol: str) -> tuple:
        intent, target, near, first, begun = state
        if symbol == "E":
            return self.start
        if symbol == "Q":
            return state
        if symbol == "H" and not target and (intent or not begun):
            near = REACH if intent else CALL_REACH
        elif symbol == "T" or symbol == "P" and near > 0 and first:
            near = 0
        elif near > 0:
            near = near - 1 or -1
        return intent | (symbol == "W"), target | (symbol == "T"), near, first | (symbol == "S"), 1

    def output(self, state: tuple, symbol: str) -> str:
        intent, target, near, first, begun = state
        if symbol == "I":
            return "insult "
        if symbol == "H" and (intent or not begun):
            return "threat " if target else "open threat "
        if symbol == "P":
            return "near " if near > 0 and first else ""
        return ("near " if near > 0 else "far ") if symbol == "T" and near else ""


class Composed:
    """The product of the transducers, built state by state as texts need it."""

    def __init__(self, *parts) -> None:
        self.parts = parts
        self.start = tuple(p.start for p in parts)
        self.known: dict[tuple[tuple, str], tuple[tuple, str]] = {}

    def step(self, state: tuple, symbol: str) -> tuple[tuple, str]:
        found = self.known.get((state, symbol))
        if found is None:
            after = tuple(p.step(s, symbol) for p, s in zip(self.parts, state))
            said = "".join(p.output(s, symbol) for p, s in zip(self.parts, state))
            found = self.known[state, symbol] = (after, said)
        return found


GRAMMAR = Composed(Match(), Window("T", "targeted ", REACH), Window("N", "negated ", 3), Reported())


def features(text: str) -> set[str]:
    """Words, and stems with their number: ``stem*2`` where two words begin with it."""
    words = [w for w in _WORD.findall(text.lower()) if len(w) > 2]
    stems = Counter(w[:k] for w in words for k in STEMS if len(w) > k)
    return {*words, *(f"{stem}*{m}" for stem, n in stems.items() for m in REPEATS if n >= m)}


class Grammar:
    """The lexicon's log odds, the contexts' weights, and the rest's log odds."""

    def __init__(self) -> None:
        self.lexicon: dict[str, float] = {}
        self.contexts: dict[str, float] = {}
        self.rest = -4.0
        self.stems: set[str] = set()
        self.memo: dict[str, tuple[str, ...]] = {}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "memo": {}}

    def learn(self, lexicon: dict[str, float]) -> None:
        self.lexicon = lexicon
        self.stems = {f.split("*")[0] for f in lexicon if "*" in f}

    def entries(self, word: str) -> tuple[str, ...]:
        """The word and its stems, as far as the lexicon has them; a threat too."""
        memo = self.memo
        found = memo.get(word)
        if found is None:
            if len(memo) > MEMO_WORDS:
                memo.clear()
            found = (word,) if word in self.lexicon or word in THREAT else ()
            found += tuple(word[:k] + "*" for k in STEMS if len(word) > k and word[:k] in self.stems)
            if len(word) <= 64:
                memo[word] = found
        return found

    def insults(self, low: str) -> dict[str, float | None]:
        """Log odds of the text's words that are insults, none for threats; a stem's follow
        from how often the text has it."""
        entries = self.entries
        had: Counter[str] = Counter()
        words: dict[str, tuple[str, ...]] = {}
        for w in _WORD.findall(low):
            found = entries(w)
            if found:
                had.update(found)
                words[w] = found
        out: dict[str, float | None] = {}
        for w, found in words.items():
            odds = [
                self.lexicon[f] for e in found
                for f in ((e,) if e[-1] != "*" else [f"{e}{m}" for m in REPEATS if had[e] >= m]) if f in self.lexicon
            ]
            if odds or w in THREAT:
                out[w] = max(odds) if odds else None
        return out

    def clauses(self, text: str) -> Iterator[tuple[str, float]]:
        """Context and log odds of each match."""
        low = text.lower()
        insults = self.insults(low)
        if not insults:
            return
        state = GRAMMAR.start
        opened: list[str] = []  # contexts of threats without a target so far
        for m in _PART.finditer(low):
            w = m.group()
            odds = None
            if not w[0].isalpha():
                symbol = "E" if w in ".!?;:\n" else "Q"
            elif (odds := insults.get(w)) is not None:
                symbol = "I"
            elif w in THREAT:
                symbol, odds = "H", THREAT_WEIGHT
            else:
                symbol = (
                    "T" if w in TARGET else "N" if w in NEGATION else "R" if w in REPORT else "W" if w in INTENT
                    else "P" if w in THIRD else "S" if w in FIRST else "O"
                )
            state, said = GRAMMAR.step(state, symbol)
            if symbol == "E":
                opened.clear()
            elif not said:
                continue
            elif symbol in "TP":
                for context in opened:
                    yield context if said == "near " else f"{context} distant", THREAT_WEIGHT
                opened.clear()
            elif said.startswith("open "):
                opened.append(said[5:].strip())
            elif odds is not None and "insult" in said:
                yield said.strip(), odds
            elif odds is not None and "threat" in said:
                yield said.strip() if "targeted" in said else f"{said.strip()} distant", odds

    def weight(self, context: str) -> float:
        """As learnt; of a context the sample does not show, none for insults and for
        threats with a near target, and a low one for other threats."""
        known = self.contexts.get(context)
        if known is not None:
            return known
        doubtful = context.startswith("threat") and any(w in context for w in ("distant", "negated", "reported"))
        return DOUBT if doubtful else 0.0

    def score(self, text: str) -> float:
        """The probability of the strongest clause; more clauses add a little."""
        best, n = -math.inf, 0
        for context, odds in self.clauses(text):
            best, n = max(best, odds + self.weight(context)), n + 1
        return _sigmoid(best + 0.05 * math.log(n) if n else self.rest)


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def _odds(a: float, b: float) -> float:
    return math.log((a + 0.5) / (b + 0.5))


# ---- learning -----------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``label_id``, ``text``, ``label`` of at most ``rows`` labelled documents outside the
    held-out fold.

    Of rows that repeat a doc_id, the text with the smallest hash stands for all.
    """
    known = labels.select(labels["doc_id"].cast("long").alias("label_id"), labels["toxic"].cast("int").alias("label")).dropna()
    once = known.where(~held_out(F.col("label_id"))).groupBy("label_id").agg(F.max("label").alias("label"))
    sample = written(once.orderBy(F.xxhash64("label_id"), "label_id").limit(rows), "toxic-labels")
    said = texts(docs)
    found = said.join(F.broadcast(sample), said["doc_id"] == sample["label_id"])
    one = found.groupBy("label_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("one"))
    return one.select("label_id", "one.text", "label")


def band_keys(text: str) -> np.ndarray:
    """A key per band: minima of hashes over the text's runs of words."""
    w = text.lower().split()
    runs = [" ".join(w[i:i + RUN_WORDS]) for i in range(max(1, len(w) - RUN_WORDS + 1))]
    h = np.fromiter((xxhash.xxh64_intdigest(r) for r in runs), np.uint64, len(runs))
    odd = np.arange(1, 2 * BANDS * BAND_ROWS, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    low = np.empty(len(odd), np.uint64)
    for k, factor in enumerate(odd):
        mixed = h * factor
        mixed ^= mixed >> np.uint64(29)
        low[k] = (mixed * np.uint64(0xBF58476D1CE4E5B9)).min()
    return np.array([xxhash.xxh64_intdigest(low[k:k + BAND_ROWS].tobytes()) for k in range(0, len(low), BAND_ROWS)], np.uint64)


def _band(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        for part in sliced(batch):
            keys = [band_keys(t) for t in part.column("text").to_pylist()]
            yield batches({
                "id": pa.array(np.repeat(part.column("label_id").to_numpy(), BANDS)),
                "label": pa.array(np.repeat(part.column("label").to_numpy(), BANDS)),
                "band": pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(keys))),
                "key": pa.array(np.concatenate(keys).view(np.int64)),
            }, _KEYS)


def independent(sample: DataFrame) -> DataFrame:
    """The rows of a sample, one of each group of copies with one label.

    A text that was copied with small changes, and labelled each time, is one finding
    and not many: what else its copies share by chance would pass for evidence.
    The row with the smallest ``label_id`` stays. ``sample`` must be read from files.
    """
    keys = written(arrow_map(sample.select("label_id", "text", "label"), _band, "id long, label int, band int, key long"), "toxic-bands")
    at = ["label", "band", "key"]
    first = keys.groupBy(*at).agg(F.min("id").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    linked = components(keys.join(first, at).selectExpr("id as a", "b"))
    return sample.join(linked, sample["label_id"] == linked["id"], "left_anti")


def _count_features(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of toxic and clean documents with each feature, added up in the task.
    The row of the feature "" counts the documents."""
    toxic: Counter[str] = Counter()
    clean: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        names = list(toxic.keys() | clean.keys())
        return batches({"feature": names, "toxic": [toxic[f] for f in names], "clean": [clean[f] for f in names]}, _FEATURES)

    for batch in stream:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            (toxic if label else clean).update(features(text))
            (toxic if label else clean)[""] += 1
            if len(toxic) + len(clean) > 300_000:
                yield out()
                toxic.clear()
                clean.clear()
    yield out()


def _find_features(stream: Iterator[pa.RecordBatch], wanted: frozenset[str]) -> Iterator[pa.RecordBatch]:
    """The candidates in each document."""
    for batch in stream:
        found = [sorted(features(t) & wanted) for t in batch.column("text").to_pylist()]
        yield batches({"found": found, "label": batch.column("label")}, _FOUND)


def _related(a: str, b: str) -> bool:
    """Whether one's letters begin the other's."""
    a, b = a.split("*")[0], b.split("*")[0]
    return a.startswith(b) or b.startswith(a)


def _lexicon(docs: list[tuple[list[str], int]], limit: float) -> dict[str, float]:
    """Covers of the toxic documents, each by other words than those before: documents
    hold several insults, and one that hides behind another here may be alone elsewhere."""
    chosen: dict[str, float] = {}
    while True:
        more = _cover(docs, limit, 9 if chosen else 2)
        chosen |= more
        if not more:
            return chosen
        found = {f for some, _ in docs for f in some}
        gone = {f for f in found if any(_related(f, c) for c in more)}
        docs = [([f for f in some if f not in gone], label) for some, label in docs]


def _cover(docs: list[tuple[list[str], int]], limit: float, least: int) -> dict[str, float]:
    """Again and again the strongest feature among the documents that no feature so
    far is in, while chance does not explain it. Of its documents, more than
    ``least`` times as many must be toxic as clean."""
    holders: dict[str, list[int]] = {}
    counts: dict[str, list[int]] = {}
    for k, (found, label) in enumerate(docs):
        for f in found:
            holders.setdefault(f, []).append(k)
            counts.setdefault(f, [0, 0])[0 if label else 1] += 1
    whole = {f: tuple(c) for f, c in counts.items()}
    toxic = sum(1 for _, label in docs if label)
    clean = len(docs) - toxic
    explained = [False] * len(docs)
    chosen: dict[str, float] = {}
    while toxic and clean:
        share = toxic / (toxic + clean)
        strength, name = max(((_strength(*c, share, least), f) for f, c in counts.items()), default=(0.0, ""))
        if strength <= limit:
            break
        chosen[name] = _odds(*whole[name])
        for k in holders[name]:
            if explained[k]:
                continue
            explained[k] = True
            found, label = docs[k]
            toxic, clean = toxic - bool(label), clean - (not label)
            for f in found:
                counts[f][0 if label else 1] -= 1
    return chosen


def _strength(a: int, b: int, share: float, least: int) -> float:
    """n times the divergence of a / n from the share: minus the log of Chernoff's bound."""
    if a <= least * b:
        return 0.0
    n = a + b
    p = a / n
    return n * (p * math.log(p / share) + ((1 - p) * math.log((1 - p) / (1 - share)) if b else 0.0))


def _count_contexts(stream: Iterator[pa.RecordBatch], grammar: Grammar) -> Iterator[pa.RecordBatch]:
    """Documents whose matches all have one context, by context, and all matched
    ("any") and unmatched ("") documents."""
    found: dict[str, list[int]] = {}
    for batch in stream:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            seen = {context for context, _ in grammar.clauses(text)}
            for name in ([*seen, "any"] if len(seen) == 1 else ["any"] if seen else [""]):
                found.setdefault(name, [0, 0])[0 if label else 1] += 1
    yield batches({
        "context": list(found), "toxic": [a for a, _ in found.values()], "clean": [b for _, b in found.values()],
    }, _CONTEXTS)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, candidates: int = CANDIDATES) -> Grammar:
    """Learn the lexicon and the weights from a bounded sample of labelled rows.

    ``rows`` bounds the sample; ``candidates`` the features that are tried for the
    lexicon, those with the most toxic documents beyond twice their clean ones. Of
    copies in the sample one is learnt from (``independent``).

    A word or stem enters the lexicon if so many of its documents are toxic that
    chance would make one wrong entry in twenty models (an upper bound of the
    binomial tail, over all features that were counted). What the lexicon explains is
    left out of the next choice, so that what is rare overall, such as another
    language's words, is tested among what is still unexplained. The driver gets the
    candidates in the documents of the sample, which is bounded.
    """
    sample = written(independent(written(training_rows(docs, labels, rows), "toxic-rows")), "toxic-sample")
    grammar = Grammar()
    counts = arrow_map(sample, _count_features, "feature string, toxic long, clean long")
    counts = written(counts.groupBy("feature").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")), "toxic-features")
    tried = counts.where("feature <> '' and a + b >= 2")
    likely = tried.where("a > 2 * b").orderBy(F.desc(F.expr("a - 2 * b")), "feature").limit(candidates)
    wanted = frozenset(r["feature"] for r in likely.select("feature").collect())
    if wanted:
        found = arrow_map(sample, lambda s: _find_features(s, wanted), "found array<string>, label int").collect()
        grammar.learn(_lexicon([(r["found"], r["label"]) for r in found], math.log(max(tried.count(), 1) / CHANCE)))
    if not grammar.lexicon:
        grammar.learn({w: SEED_WEIGHT for w in SEED_INSULTS})
    seen = {
        r["context"]: (r["a"], r["b"]) for r in arrow_map(
            sample, lambda s: _count_contexts(s, grammar), "context string, toxic long, clean long"
        ).groupBy("context").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")).collect()
    }
    a, b = seen.pop("any", (0, 0))
    if "" in seen:
        grammar.rest = min(_odds(*seen.pop("")), -1.0)
    if a + b:
        base = (a + 0.5) / (a + b + 1)
        for context, (x, y) in seen.items():
            # A context differs from all matches as far as its documents show.
            grammar.contexts[context] = math.log((x + PRIOR * base) / (y + PRIOR * (1 - base))) - math.log(base / (1 - base))
    return grammar


def score_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, candidates: int = CANDIDATES) -> DataFrame:
    """``doc_id, held_out, score, predicted``, a row per row.

    A score depends on the text alone. A null text is an empty one; a text without
    a match has the rate of such documents as its score. Rows without doc_id are
    not held out, and never learnt from. Several labels of one id: toxic if one says
    so. Without labels a small given lexicon is used. ``rows`` and ``candidates`` bound the
    sample and the features tried (``fit``). An empty table gives no rows.
    Other columns are ignored.
    """
    grammar = fit(docs, labels, rows, candidates)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in sliced(batch):
                yield batches({
                    "doc_id": part.column("doc_id"), "score": [grammar.score(t) for t in part.column("text").to_pylist()],
                }, schema)

    out = arrow_map(texts(docs), task, "doc_id long, score double")
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_clean(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, candidates: int = CANDIDATES) -> DataFrame:
    """The documents that are not predicted to be toxic, with all their columns."""
    grammar = fit(docs, labels, rows, candidates)
    ship_package(docs.sparkSession)

    @F.pandas_udf("double")
    def score(said: pd.Series) -> pd.Series:
        return pd.Series([grammar.score(t) for t in said], dtype="float64")

    return docs.where(score(F.coalesce(docs["text"].cast("string"), F.lit(""))) < 0.5)
