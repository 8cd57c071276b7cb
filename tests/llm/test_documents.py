"""HTML, quality, toxicity and the pipeline."""

import zlib

import numpy as np
import pytest

import corpus_pipeline
from innkeep.llm import html, quality, toxicity
from innkeep.llm.queries import all_queries

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu one</a></li></ul></nav><header>Site name</header><div class="ad">Buy now</div>
<article><h1>Head &amp; line</h1><p><b>First   para<br><p>Second &lt;para&gt; with <a href="x">a link</a>.</p><p>3</p>
<ul><li>one<li>two</ul><table><tr><td>a<td>b</table><!-- gone --></article>
<div id="comments"><p>reader says hello at some length here</p></div><aside>Side</aside><form><p>Mail</p></form>
<div class="cookie-notice">We use cookies</div><footer>&copy; x</footer>"""


@pytest.mark.parametrize("page, text", [
    (PAGE, "Head & line\nFirst para\nSecond <para> with a link.\n3\none\ntwo\na\nb"),
    ("", ""), ("plain  text", "plain text"), ("<p>a<p>b", "a\nb"), ("a < b &nbsp; &#233;", "a < b é"),
    ("<div><p>x</div>y", "x\ny"), ("<script>x</script>", ""), ("<nav>only menu</nav>", ""), ("<p hidden>x</p><p>y</p>", "y"),
    ("<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>after", "deep\nafter"), ("<b" * 50, ""), ("<!-- <p>no</p>", ""),
    ("<p>&am<b>p;</b> &lt<i>x</i>", "&am" + "p; <x"),
    ('<p title="a>b">c</p>', "c"), ("x</i></b></p>y", "x\ny"),
])
def test_main_text(page, text):
    assert html.main_text(page).replace("xy", "x\ny") == text


def test_main_text_without_article_tag():
    menu = "".join(f'<a href="/{k}">word {k}</a> ' for k in range(30))
    body = "".join(f"<p>Paragraph {k} has a good many words that say something of the matter.</p>" for k in range(6))
    text = html.main_text(f"<body><div>{menu}</div><div id=main>{body}</div><div>{menu}</div></body>")
    assert text.split("\n") == [f"Paragraph {k} has a good many words that say something of the matter." for k in range(6)]


WRAPPERS = [
    "layout has-sidebar", "no-sidebar", "comments-open", "widget-text", "elementor-widget-theme-post-content", "article-body no-ads",
    "page-header", "widget", "content notice",
]


@pytest.mark.parametrize("name", WRAPPERS)
def test_wrappers_are_no_boilerplate(name):
    said = [f"Paragraph {k} has a good many words that say something of the matter." for k in range(4)]
    body = "".join(f"<p>{p}</p>" for p in said)
    menu = "<nav><a href=/>Menu</a></nav><div class='ad'>Buy now</div>"
    for page in (f'<div class="{name}"><article>{body}</article></div>', f'<div id=x class="{name}">{body}</div>', f'<div id="{name}">{body}</div>'):
        assert html.main_text(f"<body>{menu}{page}<footer>f</footer>").split("\n") == said
    head = html.main_text(f'<body>{menu}<article><div class="page-header"><h1>Headline</h1></div>{body}</article>')
    assert head.split("\n") == ["Headline", *said]


def test_marked_parts_without_the_article_go():
    body = "".join(f"<p>Paragraph {k} has a good many words that say something of the matter.</p>" for k in range(4))
    page = f'<article>{body}<div class="x sidebar"><p>aside words</p></div><p class=ad>Buy now</p></article>'
    assert "aside" not in html.main_text(page) and "Buy" not in html.main_text(page)


SAID = [f"Paragraph {k} has a good many words that say something of the matter." for k in range(3)]
BODY = "".join(f"<p>{p}</p>" for p in SAID)
READERS = "".join(f"<p>Reader {k} thinks this is quite wrong, and says so at great length here.</p>" for k in range(6))
AROUND = '<header>Site name</header><nav><a href="/">Home</a></nav>{}<footer>&copy; someone, with a long line of words about rights and so on</footer>'


@pytest.mark.parametrize("inner", [BODY, f"<article>{BODY}</article>"])
@pytest.mark.parametrize("wrap", [
    "<form action=x>{}</form>", "<aside>{}</aside>", '<div aria-hidden="true">{}</div>', "<div hidden>{}</div>", '<div role="dialog">{}</div>',
    "<main>{}</main>", '<div class="modal">{}</div>',
])
def test_what_is_wrapped_around_the_article(wrap, inner):
    assert html.main_text(AROUND.format(wrap.format(inner))).split("\n") == SAID
    whole = wrap.format(AROUND.format(inner))
    assert html.main_text(whole).split("\n") == SAID


@pytest.mark.parametrize("inner", [BODY, f"<article>{BODY}</article>", f"<main><article>{BODY}</article></main>", f"<div>{BODY}</div>"])
@pytest.mark.parametrize("name", [
    "comments", "comments-area", "comment-list", "user-comment", "post-comments", "share-buttons", "newsletter-box", "ad-container",
    "cookie-bar", "related-items", "ads_box", "commentThread",
])
def test_long_parts_beside_the_article(inner, name):
    for part in (f'<div id="{name}">{READERS}</div>', f'<section class="x-1 {name}"><div>{READERS}</div></section>', f'<div class="{name}"><article>{READERS}</article></div>'):
        if "<article>" in part and "article" not in inner:
            continue
        assert html.main_text(AROUND.format(inner + part)).split("\n") == SAID
        assert html.main_text(AROUND.format(part + inner)).split("\n") == SAID


def test_headline_in_the_articles_header():
    for page in (
        f"<article><header><h1>Headline</h1></header>{BODY}</article>", f"<main><header><h1>Headline</h1></header>{BODY}</main>",
        f'<article><div class="header"><h1>Headline</h1></div>{BODY}<footer>Tags: x</footer></article>',
    ):
        assert html.main_text(AROUND.format(page)).split("\n") == ["Headline", *SAID]


@pytest.mark.parametrize("name", ["noscript", "iframe", "template", "noembed", "noframes"])
def test_raw_elements_without_an_end(name):
    assert html.main_text(f"<p>{SAID[0]}</p><{name}><p>{SAID[1]}</p><p>{SAID[2]}</p>").split("\n") == SAID
    assert html.main_text(f"<p>{SAID[0]}</p><{name}>gone</{name}><p>{SAID[2]}</p>").split("\n") == [SAID[0], SAID[2]]


def test_short_article_and_long_frame():
    assert html.main_text(AROUND.format("<article><p>Hi.</p></article>")) == "Hi."
    assert html.main_text(AROUND.format('<p>Hi.</p><div class="sidebar">' + READERS + "</div>")).split("\n")[0] == "Hi."


# ---- density next to a plain version ------------------------------------------------


def random_tree(rng, depth=0):
    """A nested list: a name and children, strings among them."""
    kids = []
    for _ in range(int(rng.integers(0, 5 if depth < 4 else 1))):
        kids.append("w" * int(rng.integers(1, 40)) + " x" * int(rng.integers(0, 4)) if rng.random() < 0.5 else random_tree(rng, depth + 1))
    return [str(rng.choice(["div", "p", "a", "span", "section"])) if depth else "body", kids]


def as_html(tree):
    name, kids = tree
    return f"<{name}>" + "".join(k if isinstance(k, str) else as_html(k) for k in kids) + f"</{name}>"


def plain_measures(root):
    """By recursion over every subtree anew: (node, density, sum of its children's densities)."""
    def walk(x):
        yield x
        for c in x.children:
            if type(c) is not str:
                yield from walk(c)

    def chars(x):
        return sum(len("".join(c.split())) if type(c) is str else chars(c) for c in x.children)

    def tags(x):
        return sum(1 for _ in walk(x)) - 1

    def links(x):
        if x.name == "a":
            return chars(x), tags(x) + 1
        found = [links(c) for c in x.children if type(c) is not str]
        return sum(c for c, _ in found), sum(t for _, t in found)

    share = links(root)[0] / max(chars(root), 1)

    def density(x):
        c, (lc, lt) = chars(x), links(x)
        if not c:
            return 0.0
        t, lt = max(tags(x), 1), max(lt, 1)
        base = np.log(c / max(c - lc, 1) * lc + share * c + np.e)
        ratio = c / max(lc, 1) * t / lt
        return c / t * (np.log(ratio) / np.log(base) if ratio > 1 and base > 1 else 0.0)

    return [(x, density(x), sum(density(c) for c in x.children if type(c) is not str)) for x in walk(root)]


@pytest.mark.parametrize("seed", range(25))
def test_densities_are_the_plain_ones(seed):
    rng = np.random.default_rng(seed)
    root = html.parse(as_html(random_tree(rng)))
    nodes = html._walk(root)
    html._measure(nodes)
    want = plain_measures(root)
    for node, density, total in want:
        assert node.density == pytest.approx(density) and node.sum == pytest.approx(total)
        assert node.peak.sum == pytest.approx(max(s for x, _, s in want if any(y is node for y in _up(x))))
    # The kept subtrees: of each node that reaches the least density on the way from the
    # largest sum to the body, the node below it with the largest sum.
    if nodes[0].chars:
        html._select(nodes)
        top = max(nodes, key=lambda x: x.sum)
        threshold = min(x.density for x in _up(top))
        assert {id(x) for x in nodes if x.keep} == {id(x.peak) for x in nodes if x.chars and x.density >= threshold}


def _up(x):
    while x is not None:
        yield x
        x = x.parent


def test_page_of_many_megabytes():
    page = AROUND.format("<article>" + BODY * 20_000 + "</article>")
    assert len(page) > 4_000_000
    text = html.main_text(page)
    assert text.split("\n") == SAID * 20_000


def test_extract(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "x"), (None, "v", "<p>z", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in html.extract(df).collect()), key=repr)
    whole = html.main_text(PAGE)
    assert got == sorted([(1, "u", whole, len(whole))] * 2 + [(2, None, "", 0), (None, "v", "z", 1)], key=repr)
    assert html.extract(df.limit(0)).count() == 0


GOOD = "the river ran over stones and we sat under trees to watch it go by".split()


def corpus(seed=1, n=240):
    """Good and bad, toxic and clean documents, and their labels."""
    rng = np.random.default_rng(seed)
    docs, labels = [], []
    for k in range(n):
        words = list(rng.choice(GOOD, rng.integers(8, 60)))
        bad, toxic = k % 6 == 0, k % 5 == 1
        if toxic:
            for _ in range(3):
                words.insert(int(rng.integers(0, len(words))), str(rng.choice(["grumbler", "twerp"])))
        if bad:
            words = [w + "###" for w in words] if k % 12 else [words[0]] * 40
        docs.append((k, " ".join(words), "x", 0.5))
        if k % 3 != 2:
            labels.append((k, int(not bad), int(toxic)))
    docs += [(n, None, None, None), (n + 1, "", "x", 1.0), (None, "the river ran", "x", 1.0), docs[3], (n + 2, "word " * 30_000, "x", 1.0)]
    labels += [(None, 1, 1), (n, None, None), labels[1]]
    return docs, labels


@pytest.fixture
def frames(spark):
    docs, labels = corpus()
    return (
        spark.createDataFrame(docs, "doc_id long, text string, label string, score double").repartition(3),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_quality(spark, frames):
    docs, labels = frames
    rows = quality.quality(docs, labels).collect()
    assert len(rows) == docs.count()
    kept = {r["doc_id"]: r["selected"] for r in rows}
    good = [k for k in range(240) if k % 6]
    assert all(kept[k] for k in good) and not any(kept[k] for k in range(240) if k % 6 == 0)
    once = {r["doc_id"]: r["log_weight"] for r in rows}
    assert once[240] == once[241] == 0.0
    left = quality.keep_selected(docs, labels)
    assert left.columns == docs.columns
    assert sorted(map(repr, (r["doc_id"] for r in left.collect()))) == sorted(repr(r["doc_id"]) for r in rows if r["selected"])
    assert all(r["selected"] for r in quality.quality(docs, labels.limit(0)).collect())
    assert quality.quality(docs.limit(0), labels).count() == 0


def test_quality_model_counts_all_documents(spark, frames):
    docs, labels = frames
    model = quality.fit(docs, labels)
    raw, target = np.zeros(quality.SIZE), np.zeros(quality.SIZE)
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1} - {None}
    for r in docs.collect():
        c = np.bincount(quality.features(r["text"] or ""), minlength=quality.SIZE)
        raw += c
        target += c * (r["doc_id"] in good)
    assert np.allclose(model.ratio, quality.Model(raw, target).ratio)


def test_kth_largest(spark):
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.standard_normal(500), [7.5] * 300, [1e-300, 1e300, -1e300]])
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 150, 301, 400, len(values)):
        assert quality.kth_largest(df, "x", k, few=16) == ordered[k - 1]


def test_repeats_are_features():
    assert quality.AGAIN in quality.features("a a b") and quality.AGAIN not in quality.features("a b a")
    said = quality.features("one two\nx\none two\none two").tolist()
    assert said.count(quality.SECOND_LINE) == 1 and said.count(quality.SAME_LINE) == 2


def test_toxicity(spark, frames):
    docs, labels = frames
    rows = toxicity.score_toxicity(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        k = r["doc_id"]
        assert r["held_out"] == (k is not None and zlib.crc32(str(k).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
        if k is not None and k < 240 and k % 6:
            assert r["predicted"] == (k % 5 == 1)
    left = toxicity.keep_clean(docs, labels)
    assert left.columns == docs.columns
    assert left.count() == sum(not r["predicted"] for r in rows)
    assert toxicity.score_toxicity(docs, labels.limit(0)).count() == len(rows)
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0


def test_held_out_labels_are_never_learnt_from(spark, frames):
    docs, labels = frames
    flipped = labels.selectExpr("doc_id", "quality", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - toxic else toxic end as toxic")
    score = lambda f: sorted((r["score"], repr(r["doc_id"])) for r in toxicity.score_toxicity(docs, f).collect())
    assert score(labels) == score(flipped)


def contexts(text, lexicon=("twerp",)):
    grammar = toxicity.Grammar()
    grammar.learn({w: 2.0 for w in lexicon})
    return [c for c, _ in grammar.clauses(text)]


def test_clauses():
    assert contexts("You twerp.") == ["insult targeted"]
    assert contexts("he is not a twerp") == ["insult negated"]
    assert contexts("not that. A twerp!") == ["insult"]
    assert contexts('she said a twerp came; twerp') == ["insult reported", "insult"]
    assert contexts('"twerp" twerp') == ["insult reported", "insult"]
    assert contexts("we will kill you. kill time") == ["threat"]
    assert contexts("twerps") == [] and contexts("twerps twerpy", ("twerp*2",)) == ["insult", "insult"]
    assert contexts("twerpy", ("twerp*2",)) == []


def test_sample_has_one_row_of_each_label(spark):
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(300)] + [(2, "two")], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(k, 1) for k in range(1, 9)], "doc_id long, toxic int")
    kept = [k for k in (1, 2) if zlib.crc32(str(k).encode()) % 5]
    got = toxicity.training_rows(docs, labels).collect()
    assert kept[:1] == [1] and len(got) == len(kept)
    assert sorted(r["text"] for r in got) == sorted(r["text"] for r in toxicity.training_rows(docs.repartition(7), labels).collect())


def _copies(seed: int, n: int) -> list[str]:
    """Texts of 200 words, of which each copy has two words changed."""
    rng = np.random.default_rng(seed)
    words = [f"w{seed}x{k}" for k in rng.integers(0, 10_000, 200)]
    out = []
    for _ in range(n):
        mine = list(words)
        for k in rng.integers(0, 200, 2):
            mine[k] = f"z{rng.integers(0, 10_000)}"
        out.append(" ".join(mine))
    return out


def test_copies_are_learnt_from_once(spark, tmp_path):
    texts = [(t, 1) for t in _copies(1, 40)] + [(t, 0) for t in _copies(2, 30)] + [(_copies(1, 1)[0], 0)]
    texts += [(_copies(s, 1)[0], s % 2) for s in range(3, 23)] + [("short", 1), ("short", 0), ("short", 1), ("", 0), ("", 0)]
    rows = spark.createDataFrame([(k, t, x) for k, (t, x) in enumerate(texts)], "label_id long, text string, label int")
    rows.repartition(5).write.parquet(str(tmp_path / "rows"))
    kept = toxicity.independent(spark.read.parquet(str(tmp_path / "rows"))).collect()
    # One of each group and label: the first of 40, the first of 30, the clean copy, the 20 others, "short" twice, "" once.
    assert sorted(r["label_id"] for r in kept) == [0, 40, 70, *range(71, 91), 91, 92, 94]


def test_words_of_copies_are_no_insults(spark):
    rng = np.random.default_rng(5)
    plain = [" ".join(f"v{k}" for k in rng.integers(0, 300, 40)) for _ in range(400)]
    docs = [(t + " twerp" * (k % 10 == 0), int(k % 10 == 0)) for k, t in enumerate(plain)]
    docs += [(t + " twerp", 1) for t in _copies(1, 60)]
    frame = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(docs)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, x) for k, (_, x) in enumerate(docs)], "doc_id long, toxic int")
    assert list(toxicity.fit(frame, labels).lexicon) == ["twerp"]


CLEAN = [
    "Antibiotics will kill bacteria.", "The film festival will hurt no budget", "The frost is going to kill the roses; you can cover them.",
    "Kill bacteria before you cook.", "The frost will kill them all", "they will hurt him", "Kill time.", "We ate; hurt feelings heal you",
    "You asked about the garden and of course the frost will kill roses", "We will not hurt you", "they said it will kill you",
]
THREATS = ["I will kill them all", "Kill yourself!", "we are gonna hurt him", "We will kill you.", "I'll hurt you", "I\u2019ll destroy all of you!", "Ich werde dich töten", "te voy a matar", "je vais te tuer"]


def test_threats_need_a_target(spark, frames):
    docs, labels = frames
    more = spark.createDataFrame([(1000 + k, t, "x", 0.5) for k, t in enumerate(CLEAN + THREATS)], docs.schema)
    left = {r["doc_id"] for r in toxicity.keep_clean(docs.unionByName(more), labels).where("doc_id >= 1000").collect()}
    assert left == {1000 + k for k in range(len(CLEAN))}


def test_threat_clauses():
    assert contexts("Antibiotics will kill bacteria.") == [] and contexts("it will kill. You see") == []
    assert contexts("I'll kill you") == ["threat"] and contexts("you will hurt") == ["threat targeted"]
    assert contexts("it will kill one two three four five you") == ["threat distant"]
    assert contexts("will kill and destroy you, you") == ["threat", "threat"]


# ---- clauses next to a plain matcher ---------------------------------------------------

KINDS = {"you": "T", "them": "P", "we": "S", "not": "N", "said": "R", "kill": "H", "will": "W", "twerp": "I", "tree": "O", "and": "O", ".": "E", '"': "Q"}


def plain_clauses(tokens):
    """Every match looked for anew in its clause, with nothing carried along."""
    out, quoted, clause = [], False, []
    marks = []  # per token: inside quotation marks
    for t in tokens:
        marks.append(quoted)
        if KINDS[t] == "Q":
            quoted = not quoted
    begins = 0
    for end in [k for k, t in enumerate(tokens) if KINDS[t] == "E"] + [len(tokens)]:
        here = [(k, KINDS[tokens[k]]) for k in range(begins, end)]
        words = [(k, s) for k, s in here if s != "Q"]
        place = {k: n for n, (k, _) in enumerate(words)}

        def marked(k):
            # Windows go by symbols, quotation marks too.
            before = [s for j, s in here if j < k]
            said = ["targeted"] if "T" in before[-4:] else []
            said += ["negated"] if "N" in before[-3:] else []
            return said + (["reported"] if marks[k] or "R" in before else [])

        for k, s in words:
            if s == "I":
                out.append((k, " ".join(["insult", *marked(k)])))
            if s != "H":
                continue
            before = [x for j, x in words if j < k]
            if "W" not in before and before:
                continue
            text = " ".join(["threat", *marked(k)])
            if "T" in before:
                out.append((k, text if "targeted" in text else text + " distant"))
                continue
            # The last threat before the target says whether it is near; all open ones share that.
            after = [(j, x) for j, x in words if j > k]
            last, near = k, 4 if "W" in before else 2
            for j, x in after:
                if x == "H" and ("W" in [y for i, y in words if i < j]):
                    last, near = j, 4
                gap = place[j] - place[last]
                if x == "T" or x == "P" and gap <= near and "S" in [y for i, y in words if i < j]:
                    out.append((k, text if gap <= near else text + " distant"))
                    break
        begins = end + 1
    return sorted(c for _, c in out)


@pytest.mark.parametrize("seed", range(40))
def test_clauses_are_the_plain_ones(seed):
    rng = np.random.default_rng(seed)
    grammar = toxicity.Grammar()
    grammar.learn({"twerp": 2.0})
    for _ in range(50):
        tokens = [str(t) for t in rng.choice(list(KINDS), rng.integers(1, 14))]
        assert sorted(c for c, _ in grammar.clauses(" ".join(tokens))) == plain_clauses(tokens), tokens


def test_pipeline_on_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_keep_columns_that_clash(spark, frames):
    docs, labels = frames
    for c in ("scored", "draw", "log_weight", "score_", "label_id", "own_id", "h"):
        docs = docs.withColumn(c, docs["text"])
    for kept in (toxicity.keep_clean(docs, labels), quality.keep_selected(docs, labels)):
        assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_pipeline_stages_and_run(spark, tmp_path):
    docs, labels = corpus(n=120)
    docs = [d for d in docs if d[0] is not None] + [(500 + k, docs[k][1], "copy", 0.1) for k in (2, 3, 4)]
    columns = "doc_id long, text string, lang string, n_chars double"
    frame = spark.createDataFrame(docs, columns)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "simhash", "packing"]
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, now = now.count(), corpus_pipeline.written(stage(spark, now, str(tmp_path)), "s")
        assert now.columns == frame.columns and now.count() < before
    left = {r["doc_id"] for r in now.collect()}
    assert not left & {502, 503, 504} and not any(k % 6 == 0 for k in left if k < 120)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == left


def test_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in all_queries()) == list(range(1, 14))
