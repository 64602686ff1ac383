"""Operators against brute force, on tables with nulls, empty and long texts, ties and repeated rows."""

import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from marquee.llm import (
    curriculum, divergence, language, neighbours, packing, pages, quality, simhash, substrings, tokens,
)

WORD = re.compile("[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def texts(seed=1, n=60):
    """Texts over few words with shared passages, copies, near copies, long and odd ones."""
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["the", "THE", "of", "é", "x|y", "a#", "z z"]
    passage = " ".join(pick.choice(vocabulary) for _ in range(60))
    out = [None, "", "   \n\t", "word", "a a a a " * 30, "b " * 4000]
    for _ in range(n):
        body = [pick.choice(vocabulary) for _ in range(pick.randint(1, 150))]
        if pick.random() < 0.4:
            body.insert(pick.randint(0, len(body)), passage)
        if pick.random() < 0.3:
            body.append(passage[: pick.randint(80, 200)])
        out.append(pick.choice([" ", "\n", " \x0b"]).join(body))
    out += out[10:20]
    out += [(t or "x") + " changed" for t in out[20:30]]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "xy"[i % 2], f"s{i % 5}" if i % 7 else None, 0) for i, t in enumerate(texts())]
    rows += [rows[12], rows[12], (None, "no id here " * 9, None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall(text or "")


def key(row):
    return (row[0] is None, row[0] or 0, *map(repr, row[1:]))


def same(left, right):
    assert sorted(left, key=key) == sorted(right, key=key)


def test_repeats(docs, empty):
    rows = docs.collect()
    count = collections.Counter()
    for r in rows:
        w = words(r.text)
        count.update(tuple(w[i: i + 35]) for i in range(len(w) - 34))
    expected = []
    for r in rows:
        w = words(r.text)
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if count[tuple(w[i: i + 35])] > 1:
                gone[i: i + 35] = [True] * 35
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        expected.append((r.doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    found = substrings.remove_repeats(docs, with_text=False).select("doc_id", "n_words", "n_removed", "kept").collect()
    same(map(tuple, found), expected)
    assert any(0 < e[2] < e[1] for e in expected)
    assert substrings.remove_repeats(empty).count() == 0


def test_repeats_keep_texts_without_any(docs):
    before = {(r.doc_id, r.text) for r in docs.collect()}
    for r in substrings.remove_repeats(docs).collect():
        if not r.n_removed:
            assert (r.doc_id, r.kept) in before


def fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i: i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closure(values, distance):
    """Component of each value by repeated passes over all pairs."""
    root = {v: v for v in values}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(values, 2):
            if (a ^ b).bit_count() <= distance and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    return root


def test_simhash_groups(docs, empty):
    rows = docs.collect()
    root = closure({fingerprint(r.text) for r in rows}, 3)
    least = {}
    for r in rows:
        if r.doc_id is not None:
            k = root[fingerprint(r.text)]
            least[k] = min(least.get(k, r.doc_id), r.doc_id)
    expected = [(r.doc_id, fingerprint(r.text), least.get(root[fingerprint(r.text)])) for r in rows]
    found = simhash.groups(docs).select("doc_id", "print", "component_id").collect()
    same([(r.doc_id, r.print % (1 << 64), r.component_id) for r in found], expected)
    assert simhash.groups(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0
    kept = simhash.keep_one(docs).collect()
    assert len(kept) == len(set(root.values()))
    assert {r.doc_id for r in kept} == {least.get(k) for k in root.values()}


def test_near_pairs_are_complete(spark):
    pick = random.Random(3)
    base = [pick.getrandbits(64) for _ in range(20)] + [0, (1 << 64) - 1]
    prints = set(base)
    for b in base:
        for _ in range(15):
            prints.add(b ^ sum(1 << i for i in pick.sample(range(64), pick.randint(1, 4))))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    expected = {frozenset((a, b)) for a, b in itertools.combinations(prints, 2) if (a ^ b).bit_count() <= 3}
    frame = spark.createDataFrame([(signed(p),) for p in prints], "print long")
    found = [frozenset((r.low % (1 << 64), r.high % (1 << 64))) for r in simhash.near_pairs(frame).collect()]
    assert set(found) == expected and len(found) == len(expected)


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(300, 301)]
    frame = spark.createDataFrame(edges, "low long, high long")
    found = {r.node: r.root for r in simhash.components(frame).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}, 301: 300}


def test_components_write_few_tables(spark, monkeypatch):
    pick = random.Random(5)
    pairs = [(n, pick.randrange(max(0, n - 9), n)) for n in range(1, 3000) if pick.random() < 0.99]
    pairs += [tuple(sorted(pick.sample(range(5000, 6000), 2), reverse=True)) for _ in range(900)]
    names = [pick.getrandbits(64) - (1 << 63) for _ in range(6000)]
    root = {names[n]: names[n] for n in range(6000)}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    edges = [(min(names[a], names[b]), max(names[a], names[b])) for a, b in pairs]
    for low, high in edges:
        first, second = sorted((top(low), top(high)))
        root[second] = first
    labels, write = [], simhash.written
    monkeypatch.setattr(simhash, "written", lambda df, label: labels.append(label) or write(df, label))
    frame = spark.createDataFrame(edges, "low long, high long").repartition(8)
    rows = simhash.components(frame).collect()
    assert len(rows) == len({r.node for r in rows})
    assert {r.node: r.root for r in rows} == {n: top(n) for n in root if top(n) != n}
    assert len(labels) <= 16


def test_stars_of_a_stretch():
    u, v = simhash._stars(np.array([5, 9, 4, 8, -2]), np.array([4, 8, 3, 5, -7]))
    assert dict(zip(u.tolist(), v.tolist())) == {4: 3, 5: 3, 8: 3, 9: 3, -2: -7}
    batches = [pa.RecordBatch.from_pydict({"u": [i + 1], "v": [i]}) for i in range(6)]
    assert [b.to_pydict() for b in simhash._contracted(batches)] == [{"u": [1, 2, 3, 4, 5, 6], "v": [0] * 6}]
    assert not list(simhash._contracted([]))


def test_base_rules(docs, empty):
    def base(text):
        w, t = words(text), text or ""
        count = collections.Counter(tuple(w[i: i + 3]) for i in range(len(w) - 2))
        inside = [False] * len(w)
        for i in range(len(w) - 2):
            if count[tuple(w[i: i + 3])] > 1:
                inside[i: i + 3] = [True] * 3
        lines = [x for x in t.split("\n") if WORD.search(x)]
        n, repeats = len(w), sum(inside)
        return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), repeats,
                n < 50 or 100 * repeats > 50 * n)

    found = divergence.quality(docs).collect()
    same([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found],
         [(r.doc_id, *base(r.text)) for r in docs.collect()])
    assert all(not r.kept for r in found if r.base_failed)
    assert divergence.quality(empty).count() == 0


def test_repeats_are_decided_by_words(spark):
    """With two hash bits nearly every window has a chance match."""
    pick = random.Random(3)
    words = [pick.choice("abcd") + pick.choice("xyz") for _ in range(400)]
    rows = spark.createDataFrame([(words,)], "words array<string>").withColumn("shift", F.lit(62))
    for name, column in (("packed", divergence._starts(F.size("words"), F.col("shift"))),
                         ("likely", divergence._likely(F.col("shift"))), ("windows", divergence._windows()),
                         ("starts", divergence._repeated())):
        rows = rows.withColumn(name, column)
    windows = [tuple(words[i: i + 3]) for i in range(398)]
    found = rows.select("likely", "starts").first()
    assert found.starts == [i for i, w in enumerate(windows) if windows.count(w) > 1]
    assert len(found.likely) == 398 > len(found.starts) > 0


def test_odd_characters_are_rejected(spark):
    plain = "the man and the dog of that house went to the sea for a day with you. " * 12
    pick = random.Random(5)
    varied = [" ".join(pick.sample(plain.split(), len(plain.split()))) for _ in range(40)]
    odd = " ".join(w + "***" for w in varied[0].split())
    rows = [(i, t, "en", "s", 0) for i, t in enumerate([*varied, odd])]
    found = {r.doc_id: r for r in divergence.quality(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not found[40].kept
    assert all(found[i].class_distance < 0.15 for i in range(40))


def test_short_texts_with_odd_characters_are_rejected(spark):
    plain = "the man and the dog of that house went to the sea for a day with you. " * 4
    pick = random.Random(5)
    varied = [" ".join(pick.sample(plain.split(), len(plain.split()))) for _ in range(40)]
    odd = " ".join(w if w in divergence.COMMON_WORDS else w + "***" for w in varied[0].split())
    rows = [(i, t, "en", "s", 0) for i, t in enumerate([*varied, odd])]
    found = {r.doc_id: r for r in divergence.quality(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(odd) < 700 and not found[40].base_failed and found[40].word_distance < 0.2
    assert not found[40].kept
    assert sum(found[i].kept for i in range(40)) == sum(not found[i].base_failed for i in range(40)) > 30


def test_texts_without_common_words_are_rejected(spark):
    pick = random.Random(9)
    letters = [chr(97 + i) for i in range(26)]
    random_word = lambda: "".join(pick.choice(letters) for _ in range(pick.randint(2, 6))) + "q"
    body = lambda n, common: " ".join(pick.choice(("the", "of", "and", "to")) if pick.random() < common else random_word() for _ in range(n))
    rows = [(i, body(400, 0.22), "en", "s", 0) for i in range(60)] + [(100, body(400, 0), "en", "s", 0), (101, body(60, 0), "en", "s", 0)]
    found = {r.doc_id: r for r in divergence.quality(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(found[i].kept for i in range(60))
    for i in (100, 101):
        assert not found[i].base_failed and found[i].class_distance < divergence.MAX_CLASS_DISTANCE
        assert 0.3 < found[i].word_distance < 0.4 and not found[i].kept


def test_forward_backward_is_exact():
    draw = np.random.default_rng(0)
    k, lengths = 3, [1, 4, 2, 5]
    n = sum(lengths)
    start = np.zeros(n, bool)
    start[np.cumsum([0, *lengths[:-1]])] = True
    logits, trans, init = draw.normal(size=(n, k)), draw.normal(size=(k, k)), draw.normal(size=k)
    marginals, transitions = language.forward_backward(logits, start, trans, init)
    pairs, at = np.zeros((k, k)), 0
    for length in lengths:
        weights = {}
        for path in itertools.product(range(k), repeat=length):
            s = init[path[0]] + sum(logits[at + t, y] for t, y in enumerate(path))
            weights[path] = math.exp(s + sum(trans[a, b] for a, b in zip(path, path[1:])))
        z = sum(weights.values())
        for t in range(length):
            exact = [sum(w for p, w in weights.items() if p[t] == y) / z for y in range(k)]
            assert np.allclose(marginals[at + t], exact)
        for p, w in weights.items():
            for a, b in zip(p, p[1:]):
                pairs[a, b] += w / z
        at += length
    assert np.allclose(transitions(), pairs)


def test_long_chains_agree_with_plain_recursion(monkeypatch):
    draw = np.random.default_rng(1)
    logits, start = draw.normal(size=(1000, 4)), draw.random(1000) < 0.01
    start[0] = True
    trans, init = draw.normal(size=(4, 4)), draw.normal(size=4)
    one, _ = language.forward_backward(logits, start, trans, init)
    monkeypatch.setattr(language, "STRETCH", 2000)
    whole, _ = language.forward_backward(logits, start, trans, init)
    assert np.allclose(one, whole)


def test_languages_of_odd_texts(docs, empty, spark):
    model = language.fit(["the cat and the dog " * 20, "le chat et la souris " * 20], ["en", "fr"])
    assert model.labels == ["en", "fr"]
    rows = [(1, "the dog and the cat"), (2, "la souris et le chat"), (3, "123 ... —"), (4, None), (5, ""), (6, "the cat " * 9000)]
    found = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert [found[i].lang_pred for i in range(1, 7)] == ["en", "fr", "und", "und", "und", "en"]
    mixed = language.Tokens(pa.array(["the cat and the dog " * 3 + "le chat et la souris " * 3]))
    marginals, _ = language.forward_backward(model.logits(mixed), mixed.starting(), model.trans, model.init)
    assert list(marginals.argmax(axis=1)) == [0] * 15 + [1] * 15
    assert language.train(empty) is None
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}
    assert language.identify(docs, language.train(docs)).count() == docs.count()


def test_quality_of_odd_tables(docs, empty, spark):
    labels = spark.createDataFrame([(i, int(i % 3 > 0), None) for i in range(70)] + [(None, 1, 0), (5, None, 0)],
                                   "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    rows = quality.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.train(docs, labels.limit(0)) is None and quality.train(empty, labels) is None
    assert {r.score for r in quality.score(docs, None).collect()} == {0.5}
    assert quality.score(empty, model).count() == 0


def test_positive_unlabelled_learning_tells_the_classes():
    draw = np.random.default_rng(2)
    size = len(quality.FEATURES)
    good, bad = draw.normal(0, 1, (12000, size)), draw.normal(0, 1, (1800, size))
    bad[:, 3] += 4
    model = quality.fit(good[:4000], np.vstack([good[4000:], bad]), prior=8000 / 9800)
    clean, fresh = model.score(draw.normal(0, 1, (500, size))), draw.normal(0, 1, (500, size))
    fresh[:, 3] += 4
    odd = model.score(fresh)
    assert (clean >= 0.3).mean() > 0.95
    assert (clean[:, None] > odd[None, :]).mean() > 0.97


PAGE = """<html><head><title>t</title><style>p{}</style></head><body class="menu-left"><nav>Home <a>News</a></nav>
<header>Site</header><aside>More</aside><div class="cookie-notice">We use cookies</div><!-- <p>no</p> -->
<article><header><h1>Head &amp; tail</h1></header><p>One <b>two
 three<br>four<p>Five&nbsp;six &lt;x&gt;</p><div class="ad">Buy</div><form>Name</form><script>"</p>"</script>
<ul><li>a</li><li>b</ul><section id="comments"><p>First!</p></section><footer>by me</footer></article><footer>&copy;</footer>"""


def test_blocks_of_a_page():
    assert [t for _, t in pages.blocks(PAGE)] == ["Head & tail", "One two three four", "Five six <x>", "a", "b"]
    assert pages.blocks("") == [] and pages.blocks("<p>a<p>b") == [(0, "a"), (0, "b")]


def test_marked_elements_are_judged_by_what_they_hold():
    texts = lambda page: [t for _, t in pages.blocks(page)]
    story = "<p>A story of some length is told here.</p><p>It goes on for a while.</p>"
    told = ["A story of some length is told here.", "It goes on for a while."]
    for words in ("site has-sidebar", "no-sidebar", "comments-open", "post-related-7", "entry with-ads"):
        assert texts(f'<div class="{words}">{story}<div class="sidebar">More of our stories</div></div><p>Skip</p>')[:2] == told
        assert texts(f'<div class="page {words}"><x-app id="no-menu">{story}</x-app></div>') == told
    for wrapper in ("banner", "site sidebar"):
        assert texts(f'<div class="{wrapper}"><article>{story}</article></div>') == told
        assert texts(f'<div class="{wrapper}"><h1>Head</h1>{story}</div>') == ["Head", *told]
    # Comments stay out however long they are, with or without an article beside them.
    comments = "<div class='comments'>" + "<p>I have much to say about all that and more</p>" * 20 + "</div>"
    assert texts(f"<article>{story}</article>{comments}") == texts(f"<div>{story}</div>{comments}") == told
    assert texts(f"<article>{story}{comments}</article>") == told and texts(comments) == []
    assert texts(f"<article>{story}<section id=comments><article class=comment><p>No!</p></article></section></article>") == told
    assert texts(f"<article>{story}<p>Say <span class=ad>buy</span> no more</p></article>") == [*told, "Say no more"]
    assert texts('<div class="cookie-notice"><p>We use cookies</p></div>') == []


def test_markup_that_is_not_well_formed():
    texts = lambda page: [t for _, t in pages.blocks(page)]
    assert texts("<p data-x=it's>First</p><p>It's the second</p><p>Third</p>") == ["First", "It's the second", "Third"]
    assert texts('<p title="a > b">One</p><p title=\'"\'>Two</p><p "odd>Three</p><p x="open>Four</p>') == ["One", "Two", "Three", "Four"]
    assert texts("<article><p>If <math><mi>x</mi></math> is <object>an object</object></p><noscript>told</noscript></article>") == [
        "If x is an object", "told"]
    assert texts("<noscript>Turn on scripts</noscript><p hidden>no</p><p class='md hidden'>yes</p><p style='display: none'>no</p>") == ["yes"]
    deep = "<div class=ad>" * 20_000 + "<p>x</p>"
    assert texts(deep) == [] and texts("<p>a</p>" + "<a b='" * 2000) == ["a", ("<a b='" * 2000)]


def test_runs_of_a_suffix_array():
    pick = random.Random(4)
    streams = [np.array([pick.randint(1, 3) for _ in range(pick.randint(0, 30))], dtype=np.uint64) for _ in range(20)]
    sizes = [np.array([int(t) * 2 for t in s], dtype=np.int64) for s in streams]
    page, at, run, length = pages.runs(streams, sizes)
    expected = {}
    for p, s in enumerate(streams):
        for i in range(len(s)):
            for j in range(i + 1, len(s) + 1):
                if sizes[p][i:j].sum() >= pages.RUN_WORDS:
                    expected[p, i] = tuple(s[i:j].tolist())
                    break
    found = {(p, i): (r, n) for p, i, r, n in zip(page.tolist(), at.tolist(), run.tolist(), length.tolist())}
    assert {k: len(v) for k, v in expected.items()} == {k: n for k, (_, n) in found.items()}
    names = collections.defaultdict(set)
    for k, v in expected.items():
        names[v].add(found[k][0])
    assert all(len(n) == 1 for n in names.values()) and len({min(n) for n in names.values()}) == len(names)


def test_repeated_runs_go_where_no_article_is_marked(spark):
    notice = "<div>This site is run by the friends of old mills and barns</div>"
    rows = [(i, f"http://a.b/{i}", f"<body>{notice}<div>Story number {i} tells of something else entirely</div>") for i in range(5)]
    rows += [(9, "http://a.b/9", rows[0][2]), (10, "http://c.d/1", rows[0][2]), (11, None, None), (None, "x", ""), (12, "http://c.d/2", PAGE)]
    articles = [(100 + i, f"http://big/{i}", f"<article><p>{i} is a story about a long way to go from here</p><p>Reprinted by kind "
                 "permission of the old people of the north</p></article>") for i in range(25)]
    quoted = [(200 + i, f"http://big/q{i}", f"<article><p>Quote {i} of many words to be kept in here</p><p>A passage which some pages quote "
               "and which stays there</p></article>") for i in range(10)]
    frame = spark.createDataFrame(rows + articles + quoted, "page_id long, url string, html string").repartition(3)
    found = {r.page_id: r.text for r in pages.main_text(frame).collect()}
    assert found[1] == "Story number 1 tells of something else entirely"
    assert found[9] == found[0] == "Story number 0 tells of something else entirely"
    assert found[10].startswith("This site") and found[11] == found[None] == ""
    assert found[101] == "1 is a story about a long way to go from here"
    # Hosts of any size, and rows that are there twice, are judged by one rule.
    notice = "<p>Printed here by leave of the old people of the north</p>"
    small = [(i, f"http://h{n}/{i}", f"<article><p>Tale {i} of {n} is about a long way to go from here</p>{notice}</article>")
             for n in (2, 3, 10, 19, 20) for i in range(n)]
    small += [row for row in small if row[1].startswith("http://h2/")]
    kept = {r.url: r.text for r in pages.main_text(spark.createDataFrame(small, frame.schema)).collect()}
    assert {url for url, text in kept.items() if "Printed" in text} == {"http://h2/0", "http://h2/1"}
    assert found[203].endswith("stays there")
    assert pages.main_text(frame.limit(0)).count() == 0


def test_near_copies_and_quotes_stay_where_no_article_is_marked(spark):
    part = lambda name, i: f"<div>Part {i} of {name} with quite enough words to make up a run of its own</div>"
    page = lambda name, *more: "<body>" + "".join(more) + "".join(part(name, i) for i in range(6)) + "</body>"
    near = [(i, f"http://near.a/{i}", page("the one story", f"<div>Printed on day {i} of the month</div>")) for i in range(6)]
    quote = "<div>A passage that two of the pages of this host both quote in full</div>"
    notice = "<div>This site is run by the friends of old mills and barns</div>"
    mixed = [(100 + i, f"http://mixed.a/{i}", page(f"story {i}", notice, quote if i < 2 else "")) for i in range(8)]
    mixed += [(200 + i, f"http://mixed.a/c{i}", page("the copied story", f"<div>Printed on day {i} of the month</div>", notice)) for i in range(10)]
    frame = spark.createDataFrame(near + mixed, "page_id long, url string, html string").repartition(3)
    found = {r.page_id: r.text for r in pages.main_text(frame).collect()}
    whole = lambda rows: {i: "\n\n".join(t for _, t in pages.blocks(html)) for i, _, html in rows}
    assert {i: found[i] for i, *_ in near} == whole(near)
    own = "This site is run by the friends of old mills and barns\n\n"
    assert {i: found[i] for i, *_ in mixed} == {i: t.replace(own, "") for i, t in whole(mixed).items()}
    assert "both quote" in found[100] and "friends of old mills" not in found[205]


def test_token_counts(docs, empty, spark):
    with open(tokens.VOCABULARY, "rb") as f:
        encode = tokens.encoder(f.read()).encode_ordinary
    same([(r.doc_id, r.n_tokens) for r in tokens.count(docs).collect()], [(r.doc_id, len(encode(r.text or ""))) for r in docs.collect()])
    assert tokens.count(empty).count() == 0
    small = docs.coalesce(2)
    for block in (1, 3, 64):
        files = tokens.write_token_files(small, block=block)
        found = collections.Counter(r.n_tokens for r in tokens.scan(files.filter("tokens is not null")).collect())
        assert found == collections.Counter(len(encode(r.text or "")) for r in docs.collect())


def test_open_end_of_a_token_file(spark):
    block = lambda *ids: bytearray(np.array(ids, dtype="<u2").tobytes())
    end = tokens.SEPARATOR
    rows = [(0, 0, block(1, 2)), (0, 1, block(3, end)), (0, 2, block(end, 4)), (0, 3, block(5)), (1, 0, block(end))]
    found = tokens.scan(spark.createDataFrame(rows, "file int, block int, tokens binary")).collect()
    assert sorted(map(tuple, found)) == [(0, 0, 3), (0, 1, 0), (0, 2, 2), (1, 0, 0)]


def test_mix(docs, empty, spark):
    sizes = curriculum.sized(docs).drop("text")
    rows = curriculum.mix(sizes).collect()
    assert len(rows) == docs.count()
    by_source = collections.defaultdict(list)
    for r in rows:
        by_source[r.source].append(r)
    names = sorted((s for s in by_source if s is not None)) + [None]
    size = {s: sum(r.size for r in by_source[s]) for s in names}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped, left = set(), 1.5 * sum(size.values())
    while True:
        level = left / sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and level * weight[s] > 2 * size[s]}
        if not over:
            break
        capped |= over
        left -= sum(2 * size[s] for s in over)
    for s in names:
        goal = 2 * size[s] if s in capped else level * weight[s]
        assert all(math.isclose(r.target, goal) and r.source_size == size[s] for r in by_source[s])
        assert sum(r.taken for r in by_source[s]) == math.floor(goal + 1e-9)
        assert all(0 <= r.taken <= 2 * r.size for r in by_source[s])
        assert sum(r.taken % r.size > 0 for r in by_source[s] if r.size) <= 1
    places = [(r.doc_id, r.position) for r in curriculum.ordered(sizes).collect() if r.position is not None]
    assert [p for _, p in places] == sorted(p for _, p in places) and all(0 <= p <= 1 for _, p in places)
    again = curriculum.ordered(sizes.repartition(7)).collect()
    same([tuple(r) for r in again], [tuple(r) for r in rows])
    training = curriculum.training_rows(docs)
    expected = collections.Counter()
    for r in rows:
        expected[r.doc_id] += math.ceil(r.taken / r.size) if r.size else 0
    assert collections.Counter(r.doc_id for r in training.collect()) == +expected
    assert curriculum.mix(curriculum.sized(empty)).count() == 0 and curriculum.training_rows(empty).count() == 0


def test_curriculum_inverts_the_schedule(spark):
    frame = spark.createDataFrame([(s, e, d / 10) for s, e in curriculum.SCHEDULE for d in range(11)], "start double, end double, demand double")
    for r in frame.withColumn("t", curriculum.position(F.col("demand"))).collect():
        asked = (r.start * r.t + (r.end - r.start) * r.t**2 / 2) / ((r.start + r.end) / 2)
        assert math.isclose(asked, r.demand, abs_tol=1e-12)


def test_packing(docs, empty):
    found = packing.pack(docs, lengths=(64, 128, 1000), shard_rows=20, with_text=True).collect()
    pieces = collections.defaultdict(list)
    for r in found:
        assert r.capacity == min(x for x in (64, 128, 1000) if x >= r.used) and sum(r.sizes) == r.used
        for doc_id, start, size, text in zip(r.doc_ids, r.starts, r.sizes, r.texts):
            assert len(words(text)) == size
            pieces[doc_id].append((start, text))
    expected = collections.defaultdict(list)
    for r in docs.collect():
        w = words(r.text)
        expected[r.doc_id] += [(i, " ".join(w[i: i + 1000])) for i in range(0, max(len(w), 1), 1000)]
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in expected.items()}
    assert packing.pack(empty).count() == 0


def test_best_fit_wastes_little():
    pick = random.Random(6)
    sizes = [pick.randint(1, 900) for _ in range(3000)]
    packed = packing.best_fit(sizes, packing.LENGTHS)
    assert sorted(i for b, _, _ in packed for i in b) == list(range(3000))
    assert sum(c for _, _, c in packed) < 1.02 * sum(sizes)


def _plain_best_fit(sizes, lengths, limit):
    """Tries every open sequence for every piece."""
    bins = []
    for size in sorted(sizes, reverse=True):
        fitting = [b for b in bins if b[1] >= size]
        if fitting:
            mine = min(fitting, key=lambda b: b[1])
        else:
            able = [x for x in lengths if x >= size]
            short = [x for x in able if x <= limit] or [min(able)]
            mine = [[], min(short, key=lambda x: packing.cost(x) / x)]
            bins.append(mine)
        mine[0].append(size)
        mine[1] -= size
    return sorted(min(x for x in lengths if x >= sum(b)) for b, _ in bins)


def test_lengths_are_opened_jointly():
    pick = random.Random(16)
    lengths, limits = packing.LENGTHS, set()
    for turn in range(60):
        sizes = [pick.randint(0, pick.choice((90, 300, 2100, 8192))) for _ in range(pick.randint(1, 60))]
        plain = {limit: _plain_best_fit(sizes, lengths, limit) for limit in lengths}
        for limit in lengths:
            assert sorted(c for _, _, c in packing._filled(sizes, lengths, limit)) == plain[limit]
        least = min(lengths, key=lambda limit: sum(map(packing.cost, plain[limit])))
        assert sorted(c for _, _, c in packing.best_fit(sizes, lengths)) == plain[least]
        limits.add(least)
    assert len(limits) > 2


def test_equal_rows_are_packed_in_all_shards(spark):
    rows = [(7, "one two three")] * 4000 + [(None, None)] * 1000 + [(8, "one two three")] * 3 + [(i, f"text {i}") for i in range(100, 1100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = packing.pack(docs, shard_rows=1000, with_text=True).collect()
    packed = collections.Counter(pair for r in found for pair in zip(r.doc_ids, r.texts))
    assert packed == collections.Counter((i, t or "") for i, t in rows)
    shards = collections.Counter()
    for r in found:
        shards[r.bin.split("-")[0]] += len(r.doc_ids)
    assert len(shards) == 7 and max(shards.values()) < 1300


def test_nearest(spark):
    draw = np.random.default_rng(8)
    rows = [(i, draw.normal(size=8).astype(np.float32).tolist(), 0) for i in range(400)]
    rows += [(1000 + i, rows[3][1], 0) for i in range(30)] + [rows[5], (2000, None, 0), (2020, [0.0] * 8, 0)]
    rows += [(2040, [float("nan")] + [1.0] * 7, 0), (2060, [None] + [1.0] * 7, 0), (None, rows[1][1], 0), (2080, [float("inf")] * 8, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    good = {i: np.array(v, dtype=np.float64) for i, v, _ in rows if i is not None and (i < 2000)}
    for k, blocks in ((20, (1024, 16384)), (3, (7, 50)), (2000, (1024, 100))):
        found = neighbours.nearest(frame.filter("vec_id % 20 = 0"), frame, k, *blocks).collect()
        expected = []
        for q in (i for i in good if i % 20 == 0):
            scored = sorted((-float(np.cumsum(good[q] * v)[-1]), i) for i, v in good.items() if i != q)[:k]
            expected += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
        assert sorted(map(tuple, found)) == sorted(expected)
    none = frame.limit(0)
    assert neighbours.nearest(none, frame).count() == 0 and neighbours.nearest(frame, none).count() == 0


def test_training_takes_one_row_of_an_id(spark):
    """A third of the rows has one id; what is learnt is bounded by ids and does not depend on the order of rows."""
    pick = random.Random(9)
    words = {"en": "the old mill of a town stands near water and stone".split(), "fr": "le vieux moulin de la ville est sur une rive".split()}
    text = lambda lang: " ".join(pick.choice(words[lang]) for _ in range(pick.randint(5, 60)))
    rows = [(i, text(lang), lang) for i in range(60) for lang in ("en", "fr")] + [(1, text("en"), "en") for _ in range(60)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id long, quality int")
    seen = []
    for turn in range(2):
        pick.shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2 + turn)
        good = quality._sample(docs, docs.filter("doc_id < 40"), 30)
        seen.append((language.train(docs, per_language=10), quality.train(docs, labels, positives=20, unlabelled=30), good))
    (tongue, kind, good), (tongue2, kind2, good2) = seen
    assert (tongue.table == tongue2.table).all() and (tongue.trans == tongue2.trans).all()
    assert (kind.weights == kind2.weights).all() and (good == good2).all() and len(good) == 30
    assert language.train(docs, bytes_per_language=10) is None
