"""Classifiers, rules, pages and vectors: held-out accuracy, brute force and hand-made cases."""

from __future__ import annotations

import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
import zstandard

from awkward import AWKWARD, documents
from skytrace.llm import common, html_text, quality, queries, rules, toxicity, vectors
from skytrace.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _held_out(spark, name, label, folds, remainder):
    rows = {r["doc_id"]: r for r in QUERIES[name](spark, SF).collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for doc_id, row in rows.items():
        assert row["held_out"] == (zlib.crc32(str(doc_id).encode()) % folds == remainder)
        assert 0.0 <= row["score"] <= 1.0
        assert row["predicted"] == int(row["score"] >= 0.5)
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    held = [(rows[r["doc_id"]], r[label]) for r in labels if rows[r["doc_id"]]["held_out"]]
    return held


def _labelled():
    """Labelled texts of a table, bad ones and good ones, in a fixed order."""
    folder = "/root/testdata/sf0.1"
    table = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"])
    texts = {r["doc_id"]: r["text"] or "" for r in table.to_pylist()}
    labels = pq.read_table(f"{folder}/labels.parquet").to_pylist()
    rows = [(texts[r["doc_id"]], r["quality"]) for r in labels if len(texts[r["doc_id"]]) < 20_000]
    random.Random(3).shuffle(rows)
    return [[t for t, y in rows if y == k] for k in (0, 1)]


def test_calibration_converges_at_any_share_of_classes():
    """The same texts under class shares from 0.05 to 0.95; none may lose the held-out texts."""
    bad, good = _labelled()
    held = good[400:900] + bad[-120:]
    y = np.repeat([1, 0], [len(good[400:900]), 120])
    dictionaries = [quality._dictionary(x[:200:2], 65_536) for x in (good, bad)]
    fit = [good[1:400:2], bad[1:200:2]]
    x = quality._features(fit[0] + fit[1], *dictionaries)
    own = np.repeat([1.0, 0.0], [len(fit[0]), len(fit[1])])
    centre, spread = x.mean(0), x.std(0) + 1e-9
    design = (x - centre) / spread
    found = {}
    for share in (0.05, 0.2, 0.5, 0.6, 0.7, 0.857, 0.95):
        weight = np.where(own == 1, share / len(fit[0]), (1 - share) / len(fit[1])) * len(own)
        beta = common.logistic(design, own, weight, ridge=1e-4)
        z = beta[0] + design @ beta[1:]
        slope = design.T @ (weight * (1 / (1 + np.exp(-z)) - own)) + 1e-4 * weight.sum() * beta[1:]
        assert np.abs(slope).max() <= 1e-5 * weight.sum()
        model = quality.QualityModel(*dictionaries, tuple(centre), tuple(spread), tuple(beta), share)
        found[share] = float(((model.score(held) >= 0.5) == y).mean())
    assert found[0.5] >= found[0.857] - 0.02
    # A share far from that of the held-out texts moves the threshold, as it should.
    assert min(found[share] for share in (0.5, 0.6, 0.7, 0.857)) > 0.95


def test_no_convergence_is_an_error():
    x = np.array([[1e308], [-1e308], [1e308]])
    with pytest.raises((ArithmeticError, np.linalg.LinAlgError)), np.errstate(all="ignore"):
        common.logistic(x, np.array([1.0, 0.0, 0.0]), np.ones(3), ridge=0.0)


def test_quality_scores_equal_the_formula(spark):
    """The registered query's scores, text by text from sizes by fresh compressors."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = queries.fitted_quality(spark, docs, folder)
    assert model.weights

    def size(data, dictionary):
        own = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        bare = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        return len(zstandard.ZstdCompressor(level=quality.LEVEL, **bare, **own).compress(data))

    got = {r.doc_id: r.score for r in QUERIES["op1_quality_classifier"](spark, folder).collect()}
    assert len(got) == docs.count()
    for row in docs.collect():
        data = (row.text or "").encode()
        g, b, p, n = (*(size(data, d) for d in (model.good, model.bad, b"")), len(data) + 1)
        plain = [(b - g) / max(b, g), g / n, b / n, p / n, math.log(n), (b - g) / n]
        features = plain + [v * v for v in plain] + [plain[0] * v for v in plain[1:]]
        z = model.weights[0] + sum(
            w * (v - c) / s
            for w, v, c, s in zip(model.weights[1:], features, model.centre, model.spread, strict=True)
        )
        assert got[row.doc_id] == pytest.approx(1 / (1 + math.exp(-max(-40.0, min(40.0, z)))), abs=1e-9)


def test_quality_on_held_out_labels(spark):
    held = _held_out(spark, "op1_quality_classifier", "quality", 3, 1)
    right = sum(row["predicted"] == y for row, y in held) / len(held)
    good = [row["predicted"] for row, y in held if y == 1]
    assert right >= 0.95
    assert sum(good) / len(good) >= 0.97


def test_toxicity_on_held_out_labels(spark):
    held = _held_out(spark, "op8_toxicity", "toxic", 5, 0)
    clean = [row["predicted"] for row, y in held if y == 0]
    assert sum(row["predicted"] == y for row, y in held) / len(held) >= 0.93
    assert sum(clean) <= 1


def test_classifiers_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    frame = documents(spark)
    good = quality.fit_quality(frame, labels)
    assert quality.quality_filter(frame, good).count() == len(AWKWARD)
    clean = toxicity.fit_toxicity(frame, labels)
    assert toxicity.toxicity_filter(frame, clean).count() == len(AWKWARD)


def test_filters_take_awkward_documents(spark):
    rng = random.Random(3)
    good = [" ".join(rng.choices(["calm", "river", "stone", "light"], k=60)) for _ in range(40)]
    bad = [" ".join(rng.choices(["BUY!!", "###", "$$$", "NOW!!"], k=60)) for _ in range(40)]
    rows = list(enumerate([*good, *bad, *(f"you idiot {t}" for t in good)])) + [
        (500 + i, t) for i, t in enumerate(AWKWARD)
    ]
    frame = documents(spark, [*rows, *rows[:2]])
    labels = [(i, int(i >= 40) ^ 1, 0) for i in range(80)] + [(i, 1, 1) for i in range(80, 120)]
    labels += [(None, 1, 1), (5, None, None)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.fit_quality(frame, labels)
    kept = quality.quality_filter(frame, model)
    assert kept.columns == frame.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert all(ids[i] >= 1 for i in range(40))
    assert not any(ids[i] for i in range(40, 80))
    assert ids[0] == 2
    lexicon = toxicity.fit_toxicity(frame, labels)
    assert "idiot" in lexicon.lexicon.words
    left = {r["doc_id"] for r in toxicity.toxicity_filter(frame, lexicon).collect()}
    assert left == set(range(80)) | {500 + i for i in range(len(AWKWARD))}
    assert quality.quality_filter(documents(spark, []), model).count() == 0


def _distances(entry, word):
    row = list(range(len(word) + 1))
    for i, a in enumerate(entry):
        before, row = row, [i + 1]
        for j, b in enumerate(word):
            row.append(min(before[j] + (a != b), before[j + 1] + 1, row[j] + 1))
    return row


def test_automaton_equals_edit_distances():
    rng = random.Random(2)
    entries = ["".join(rng.choices("abc", k=rng.choice((4, 5, 6, 7, 9, 10)))) for _ in range(12)]
    words = {e: 1 + rng.random() for e in entries[:6]}
    stems = {e: 1 + rng.random() for e in entries[6:]}
    matcher = toxicity.Matcher(toxicity.Lexicon(words, stems))
    for _ in range(3000):
        word = list(rng.choice(entries))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randint(0, 1)] = rng.choices("abcd", k=rng.randint(0, 1))
        word = "".join(word)
        best = 0.0
        for group, stem in ((words, False), (stems, True)):
            for entry, weight in group.items():
                row = _distances(entry, word)
                spent = min(row) if stem else row[-1]
                if spent <= toxicity.edits_allowed(entry, stem):
                    best = max(best, weight * toxicity.PER_EDIT**spent)
        assert math.isclose(abs(matcher.weight(word)), best)


def test_misspelled_and_quoted_terms():
    matcher = toxicity.Matcher(toxicity.Lexicon({"idiot": 4.0, "worthless": 4.0}, {"vequ": 3.0}))
    assert matcher.hits("an idiot here") == [(4.0, False)]
    assert matcher.hits("an idi0t here") == [(4.0 * toxicity.PER_EDIT, True)]
    assert matcher.hits("wrthles") == [(4.0 * toxicity.PER_EDIT**2, True)]
    assert matcher.hits("VEQUable") == [(3.0, False)]
    quoted = matcher.hits('the report said "idiot" is a rude word')
    assert quoted == [(4.0 * toxicity.QUOTED, False)]
    assert matcher.hits("you idiot") == [(4.0 * toxicity.ADDRESSED, False)]
    assert matcher.hits(None) == matcher.hits("") == matcher.hits("a patriotic idyll") == []


def test_misspelled_terms_under_a_learned_stem():
    rng = random.Random(9)
    plain = ["calm", "river", "stone", "light", "meadow", "window", "harbour", "copper"]
    fill = [[f"{w}{rng.randrange(999)}" for w in rng.choices(plain, k=12)] for _ in range(120)]
    terms = ("idiot", "idiots", "idiotic")
    toxic = [" ".join([*words[:6], terms[i % 3], *words[6:]]) for i, words in enumerate(fill[:60])]
    lexicon = toxicity.learn_lexicon(toxic, [" ".join(words) for words in fill[60:]])
    assert any("idiotic".startswith(stem) for stem in lexicon.stems)
    assert set(terms) <= set(lexicon.words)
    matcher = toxicity.Matcher(lexicon)
    for word in ("idi0t", "idot", "odiot", "idi0tic", "odiotic"):
        ((weight, misspelled),) = matcher.hits(f"an {word} here")
        assert misspelled and weight > 0
    for word in ("idiot", "idiotically"):
        ((weight, misspelled),) = matcher.hits(f"an {word} here")
        assert not misspelled and weight >= max(lexicon.stems.values())


def _measured(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_rules_measure_like_brute_force(spark):
    rng = random.Random(5)
    texts = [*AWKWARD, "a b c d e f g h", "a b c d e f g h " * 2, " x\ty\x0bz\n x\ty\x0bz\n"]
    for _ in range(200):
        n, k = rng.choice((3, 10, 40, 200)), rng.choice((2, 3, 10, 1000))
        words = rng.choices(["a", "b", "<x>", "é"] + [f"w{i}" for i in range(k)], k=n)
        gaps = rng.choices([" ", " ", " ", "\n", "\t", "  ", "\r\n", "\x0b"], k=n)
        texts.append("".join(w + g for w, g in zip(words, gaps, strict=True)))
    frame = documents(spark, [*enumerate(texts), (None, "no id"), (0, None)])
    rows = rules.ledger(frame, keep=["doc_id"]).collect()
    assert len(rows) == len(texts) + 2
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for row in rows:
        if row["doc_id"]:
            assert tuple(row[n] for n in names) == _measured(texts[row["doc_id"]])
    assert rules.ledger(documents(spark, []), keep=["doc_id"]).count() == 0


def test_policies_and_ablation(spark):
    texts = ["few words", "a b c " * 20, "# word " * 30, " ".join(f"fine{i}" for i in range(40))]
    entries = rules.ledger(documents(spark, list(enumerate(texts))), keep=["doc_id"])
    by_id = {r["doc_id"]: r for r in entries.withColumn("ok", rules.verdict("v2")).collect()}
    assert [by_id[i]["ok"] for i in range(4)] == [False, False, False, True]
    bits = {rule.name: 1 << i for i, rule in enumerate(rules.RULES)}
    assert by_id[0]["failed"] & bits["few_words"]
    assert by_id[2]["failed"] & bits["many_symbols"]
    shares = {r["rule"]: (r["n_failed"], r["n_only"]) for r in rules.ablation(entries, "v2").collect()}
    mask = rules.mask(rules.POLICIES["v2"])
    for name, (failed, only) in shares.items():
        own = [r["failed"] & mask for r in by_id.values()]
        assert failed == sum(bool(f & bits[name]) for f in own)
        assert only == sum(f == bits[name] for f in own)


def test_rules_run_without_python(spark):
    plan = rules.ledger(documents(spark), keep=["doc_id"])._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval", plan)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><a href="/">Home</a> Site</header><nav><ul><li><a href="/a">A</a></li></ul></nav>
<div id="cookie-notice">We use cookies.</div><div class="ad">Buy our things today, really.</div>
<main><article><h1>Title &amp; more</h1><p>First <b>bold</b> paragraph, with a <a href=x>link</a>.
<p>Second&nbsp;one<br>line &lt;5.<aside>Related: other things</aside><ul><li>Point one.<li>Two</ul>
<script>if (a < b) { document.write("<p>no</p>") }</script><form><label>Mail</label></form>
</article><section class="comments"><p>A reader's comment of considerable length, thank you.</p>
</section></main><div class="sidebar"><p>Sidebar text of some length. It is not content.</p></div>
<footer>&copy; Site</footer></body></html>"""


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 8000 + "</span>" * 8000,
        '<div class="ad">x ' * 4000,
        "<b>x</b><i>" * 8000,
        "<section>" * 8000 + "<p>x" * 8000,
        "<div>y" * 8000,
    ],
)
def test_deep_and_stray_tags_take_little_time(page):
    started = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - started < 1.5


def test_pages_of_a_table(spark):
    """NULL, empty, repeated and very long pages, and columns of clashing names."""
    article = "<article><p>" + "A sentence of some length, and another one. " * 9 + "</p></article>"
    pages = [None, "", article, article, "plain &amp; simple", "<nav>menu</nav>" + article * 400]
    frame = spark.createDataFrame(
        [(i, p, "x", 1) for i, p in enumerate(pages)], "page_id long, html string, text string, n_chars int"
    )
    rows = frame.select("page_id", html_text.extract()("html").alias("main")).collect()
    assert {r.page_id: r.main for r in rows} == {i: html_text.main_text(p) for i, p in enumerate(pages)}
    assert html_text.main_text(None) == html_text.main_text("") == ""
    assert frame.filter("false").select(html_text.extract()("html")).collect() == []


def test_main_text_of_pages():
    assert html_text.main_text(PAGE) == (
        "Title & more\n\nFirst bold paragraph, with a link.\n\nSecond one line <5.\n\n"
        "Point one.\n\nTwo"
    )
    assert html_text.main_text("just text") == "just text"
    for page in (None, "", "<p", "<script>x", "<!-- never closed", "</p></div>", "<" * 50):
        assert isinstance(html_text.main_text(page), str)


PROSE = "The river rose in the night and took the lower road with it. " * 3


@pytest.mark.parametrize(
    "opened",
    [
        '<article class="post hentry category-news tag-politics">',
        '<article class="post tag-social category-social comments-open">',
        '<article class="widget">',
        '<main class="search">',
        '<div class="content with-sidebar">',
        '<div class="entry-content no-sidebar no-ads">',
        '<div class="post comments-open">',
        '<div class="content-sidebar-wrap">',
    ],
)
def test_names_that_only_tell_of_bad_things(opened):
    page = f"<body>{opened}<h1>Flood</h1><p>{PROSE}</p><p>Short end.</p></{opened[1:].split()[0]}>"
    assert html_text.main_text(page) == f"Flood\n\n{PROSE.strip()}\n\nShort end."


@pytest.mark.parametrize(
    "attrs",
    [
        'href="/wiki/hidden-markov-model"',
        'title="the hidden life"',
        'data-x="hidden"',
        "data-x='a hidden b' data-hidden",
        "href=/a/hidden/b",
        "x = hidden",
        'data-style="display:none"',
        'data-class="comments" title="class=ad id=ad"',
        'data-aria-hidden="true" aria-hidden="false"',
    ],
)
def test_attributes_count_by_their_whole_name(attrs):
    page = f"<article><p>A <a {attrs}>linked</a> word.</p><div {attrs}><p>{PROSE}</p></div></article>"
    assert html_text.main_text(page) == f"A linked word.\n\n{PROSE.strip()}"
    for own in ("hidden", "HIDDEN=''", 'style="color:red;display: none"', "aria-hidden=true"):
        page = f"<article><p>{PROSE}</p><p {attrs.split(' aria-')[0]} {own}>{PROSE}</p></article>"
        assert html_text.main_text(page) == PROSE.strip()


def test_long_text_outweighs_a_bad_name():
    text = "".join(f"<p>{PROSE}</p>" for _ in range(20))
    whole = "\n\n".join([PROSE.strip()] * 20)
    for name in ("social", "sidebar", "widget"):
        side = f'<div class="{name}">{text}</div>'
        assert html_text.main_text(f"<body>{side}") == whole
        assert html_text.main_text(f"<body><article>{text}</article>{side}") == whole
    assert html_text.main_text(f'<body><section class="comments">{text}</section>') == ""
    for name in ("ad", "cookie-notice", "main-menu", "related-posts", "share-buttons", "ad-300x250"):
        page = f'<body><article><p>{PROSE}</p></article><div class="x {name}"><p>{PROSE}</p></div>'
        assert html_text.main_text(page) == PROSE.strip()


@pytest.mark.parametrize(
    "opened",
    [
        '<section class="comments">',
        '<div id="comments"><div class="x">',
        '<section class="related-posts">',
        "<aside>",
        "<nav><section>",
        "<footer>",
        '<div class="sidebar">',
        '<div class="widget"><aside><div class="promo">',
    ],
)
def test_articles_beside_the_text_stay_out(opened):
    other = f"<article><h2>Other</h2><p>{PROSE}</p></article>" * 2
    page = f"<body><main><article><p>{PROSE}</p></article></main>{opened}{other}"
    assert html_text.main_text(page) == PROSE.strip()
    inside = f"<body><main><article><p>{PROSE * 2}</p>{opened}{other}"
    assert html_text.main_text(inside) == (PROSE * 2).strip()


def test_main_parts_in_a_container_of_bad_name():
    for name, tag in (("nav-container", "main"), ("widget", "article"), ("social", "article")):
        page = f'<body><div class="{name}"><{tag}><h1>Flood</h1><p>{PROSE}</p></{tag}></div>'
        assert html_text.main_text(page) == f"Flood\n\n{PROSE.strip()}"


def test_pages_inside_a_form():
    article = f"<h1>Flood</h1><p>{PROSE}</p><p>Short end.</p>"
    whole = f"Flood\n\n{PROSE.strip()}\n\nShort end."
    controls = "<label>Mail</label><input><select><option>One<option>Two</select><button>Go</button>"
    for tag in ("article", "main"):
        page = f"<body><form runat=server><nav>Menu</nav>{controls}<{tag}>{article}</{tag}></form>"
        assert html_text.main_text(page) == whole
    long = f'<div id="content">{article * 9}</div>'
    page = f"<body><form runat=server><nav>Menu</nav>{controls}{long}<footer>Us</footer></form>"
    assert html_text.main_text(page) == "\n\n".join([whole] * 9)
    sign_up = f"<form>{controls}<p>Sign up for our letter and get the best stories each morning.</p></form>"
    assert html_text.main_text(f"<article>{article}{sign_up}</article>{sign_up}") == whole


@pytest.mark.parametrize(
    "control",
    [
        "<button>Menu",
        "<select><option>One",
        "<option>One",
        "<button>Menu <b>now</b><button>Go</button><button>More",
        "<form><label>Mail<input></form>",
    ],
)
def test_unclosed_controls_end_at_a_block(control):
    page = f"<article>{control}<p>{PROSE}</p><div><p>{PROSE}</p></div></article>"
    assert html_text.main_text(page) == f"{PROSE.strip()}\n\n{PROSE.strip()}"
    shut = f"<article><p>{PROSE}</p><button><div>Menu</div><p>Go</p></button></article>"
    assert html_text.main_text(shut) == PROSE.strip()


def test_cut_joins_good_and_bad_blocks():
    good = html_text.Block("A plain sentence that stays.", 1, True, False, False, 0.0)
    doubtful = html_text.Block("x" * 650, 1, True, True, False, 0.0, (5,))
    assert html_text.content([doubtful]) == [False]
    assert html_text.content([good, doubtful, good]) == [True, True, True]


def test_registered_pages_give_their_article(spark):
    import html

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op6_html_extraction"](spark, SF).collect()
    assert len(rows) == len(pages)
    for row in rows:
        article = re.search(r"<article>(.*)</article>", pages[row["page_id"]], re.DOTALL)[1]
        parts = re.split(r"</?p>|</?h1>|<br>", re.sub(r"</?b>", "", article))
        texts = [" ".join(html.unescape(p).split()) for p in parts]
        assert row["text"] == "\n\n".join(t for t in texts if t)
        assert row["n_chars"] == len(row["text"])


def test_flow_finds_the_least_cut():
    rng = random.Random(8)
    for _ in range(60):
        n = rng.randint(1, 7)
        ends = [(rng.random() * 3, rng.random() * 3) for _ in range(n)]
        joins = [(i, j, rng.random()) for i in range(n) for j in range(i) if rng.random() < 0.5]
        flow = html_text._Flow(n + 2)
        for i, (off, on) in enumerate(ends):
            flow.join(0, i + 2, off)
            flow.join(i + 2, 1, on)
        for i, j, w in joins:
            flow.join(i + 2, j + 2, w, w)

        def cost(side, ends=ends, joins=joins):
            own = sum(on if s else off for s, (off, on) in zip(side, ends, strict=True))
            return own + sum(w for i, j, w in joins if side[i] != side[j])

        best = min(cost([bool(k >> i & 1) for i in range(n)]) for k in range(1 << n))
        assert math.isclose(cost(flow.source_side()[2:]), best, abs_tol=1e-9)


def _nearest(rows, k):
    usable = [
        (n, i, np.array(v, float))
        for n, (i, v) in enumerate(rows)
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v)
    ]
    found = []
    for n, i, q in usable:
        if i % 20 == 0:
            scored = []
            for m, j, c in usable:
                if m != n and len(c) == len(q):
                    total = 0.0
                    for a, b in zip(q, c, strict=True):
                        total += a * b
                    scored.append((-total, j))
            found += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scored)[:k])]
    return sorted(found)


@pytest.mark.parametrize("small", [False, True])
def test_nearest_equals_brute_force(spark, monkeypatch, small):
    rng = random.Random(6)
    rows = [(i, [rng.choice((-1.0, 0.5, 2.0, rng.gauss(0, 1))) for _ in range(8)]) for i in range(300)]
    rows += [(300 + i, rows[i % 7][1]) for i in range(40)]  # ties
    rows += [(400, None), (420, []), (440, [0.0] * 8), (460, [1.0, None] * 4)]
    rows += [(480, [float("nan")] * 8), (500, [float("inf")] * 8), (None, [1.0] * 8)]
    rows += [(520, [1e150] * 8), (540, [1e-150] * 8), (560, [1.0, 2.0]), (580, [3.0, 1.0])]
    rows += [rows[0], rows[20]]  # repeated rows
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    if small:
        monkeypatch.setattr(vectors, "STRIP", 3)
    got = vectors.nearest(frame, (frame.vec_id % 20) == 0, k=20).collect()
    own = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)
    assert own == _nearest(rows, 20)


def test_ties_of_long_vectors_are_found():
    dim, n = 8192, 200

    def side(rows, ids, own):
        data = (np.array(x, t).tobytes() for x, t in ((ids, "<i8"), (own, "<i8"), (rows, "<f8")))
        return vectors._Side(dim, *data)

    for seed in range(4):
        rng = np.random.default_rng(seed)
        rows = np.ones((n, dim))
        for row in rows:
            row[rng.choice(dim, 201, replace=False)] = 0.0  # all have the same product
        heaps = [[]]
        candidates = side(rows, rng.permutation(n), np.arange(n))
        vectors._tile(side(np.ones((1, dim)), [999], [999]), candidates, heaps, 5)
        assert sorted(-key for _, key in heaps[0]) == [0, 1, 2, 3, 4]


def test_nearest_of_nothing(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vectors.nearest(frame, frame.vec_id % 20 == 0).count() == 0
