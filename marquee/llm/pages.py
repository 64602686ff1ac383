"""Main text of web pages by suffix arrays of hosts.

A page is read into blocks of text. The token streams (one token per block) of the pages of a host are
concatenated, and a suffix array finds runs of blocks that occur on distinct pages: equal prefixes of
neighbouring suffixes, cut where they hold ``RUN_WORDS`` words. Hosts are done in slices, the pages of a
task, and the slices' runs are summed by hash, so a host of any size is spread over the cluster.

What the markup says comes first. Blocks inside menus, headers, footers, adverts and the like go. An element
that only its class or id marks is judged by what it holds, too: a wrapper of the article or of most of the page's
words outside links stays. Then a run goes if it is surely on most bodies of the host: pages that hold enough
text besides what most pages of the host hold. Near copies that make up most of a host are no bodies, so they
are no witnesses against their own text. The bound follows the number of bodies without a step.
"""

import html
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.textbytes import mix, slices
from marquee.session import written

RUN_WORDS = 8
RUN_BLOCKS = 8
SITE_SHARE = 0.5
OWN_SHARE = 0.25  # of a page's words, not found on most pages of its host, from which on it is a body
CONFIDENCE = 1.64  # standard errors of the share of bodies

# Element names of HTML and words that sites use for what is not the article.
RAW = "script|style|template|svg|iframe|textarea|select|title"
ASIDE = frozenset("nav header footer aside form head button dialog menu noscript".split())
IN_ARTICLE = frozenset("header noscript".split())  # set aside outside an article only
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs masthead footer header comment comments respond disqus reply replies share sharing social "
    "related recommended widget pagination skip".split()
)
STATES = frozenset("has no not with without is open closed enabled disabled".split())
INLINE = frozenset("a abbr b cite code em font i label mark q s small span strong sub sup time u var".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog".split())

# A quote opens a value only after an equals sign; any other one is a character of the tag.
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"(?<![^\s\"'/])([^\s=\"'<>/]++)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
STYLE = re.compile(r"display\s*:\s*none", re.I)
PARTS = re.compile(r"[^a-z0-9]+")

ARTICLE, PLAIN = 1, 0
OPEN, ASIDE_FOR_SURE, MARKED, STATED = range(4)


def _attributes(text):
    """(values by lower-case name, names without a value)."""
    values = {}
    for key, *forms in ATTRIBUTE.findall(text):
        values.setdefault(key.lower(), "".join(forms))
    return values, ATTRIBUTE.sub(" ", text).lower().split()


def _kind(name, values, bare, in_article):
    """How far an element's name and attributes set it aside.

    ``STATED``: all marks are part of a statement about the page, such as ``no-sidebar`` or ``comments-open``.
    """
    if name in ASIDE and not (in_article and name in IN_ARTICLE):
        return ASIDE_FOR_SURE
    if name in ("body", "html", "article", "main") and not in_article or not (values or bare):
        return OPEN
    if (values.get("role", "").lower() in ROLES or values.get("aria-hidden", "").lower() == "true"
            or "hidden" in bare or "hidden" in values or STYLE.search(values.get("style", ""))):
        return ASIDE_FOR_SURE
    kinds = []
    for word in f"{values.get('class', '')} {values.get('id', '')}".lower().split():
        parts = PARTS.split(word)
        if not MARKS.isdisjoint(parts):
            inner = parts[0] not in MARKS and parts[-1] not in MARKS
            kinds.append(STATED if inner or not STATES.isdisjoint(parts) else MARKED)
    return min(kinds, default=OPEN)


def _wrappers(marks, words, titled):
    """Which marked elements stay open, of [parent or -1, kind, own words outside links, whether it has a title].

    Outermost first. An element that holds an article, main part or first heading is a wrapper if nothing open does,
    and a stated one if it holds more words outside links than all that is open (``words``, ``titled``).
    """
    inner = [(own, title) for _, _, own, title in marks]
    for number in range(len(marks) - 1, -1, -1):
        parent, kind, *_ = marks[number]
        if parent >= 0:
            own, title = inner[number]
            inner[parent] = (inner[parent][0] + (own if kind == STATED else 0), inner[parent][1] or title)
    is_open = []
    for (parent, kind, own, title), (size, holds) in zip(marks, inner):
        stays = (parent < 0 or is_open[parent]) and (holds and not titled or kind == STATED and size > words)
        is_open.append(stays)
        if stays:
            words, titled = words + own, titled or title
    return is_open


def blocks(page):
    """(kind, text) of the blocks of a page that the markup does not set aside, in page order."""
    found, marks, open_tags, text = [], [], [], []
    asides = articles = mains = links = linked = words = 0
    mark, titled = -1, False

    def close():
        nonlocal linked, words
        joined = " ".join(html.unescape("".join(text)).split())
        if joined and not asides:
            free = max(0, joined.count(" ") + 1 - linked)
            if mark < 0:
                words += free
            else:
                marks[mark][2] += free
            found.append((2 if articles else 1 if mains else 0, joined, mark))
        text.clear()
        linked = 0

    def leave(index):
        nonlocal asides, articles, mains, links, mark
        if any(opened[-1] for opened in open_tags[index:]):
            close()
        for name, aside, article, main, marked in open_tags[index:]:
            asides, articles, mains, links = asides - aside, articles - article, mains - main, links - (name == "a")
            if marked:
                mark = marks[mark][0]
        del open_tags[index:]

    at = 0
    for token in TOKEN.finditer(page):
        if not asides:
            text.append(page[at: token.start()])
            linked += len(text[-1].split()) if links else 0
        at = token.end()
        name = (token[3] or "").lower()
        if not name:
            continue
        if name in BLOCKS or name == "noscript":
            close()
        elif name == "br":
            text.append(" ")
        if token[2]:
            index = next((i for i in range(len(open_tags) - 1, -1, -1) if open_tags[i][0] == name), None)
            if index is not None:
                leave(index)
        elif name not in VOID and not token[4].endswith("/"):
            if name in BLOCKS:
                # A block ends an open paragraph, with whatever was left open in it.
                index = next((i for i in range(len(open_tags) - 1, -1, -1) if open_tags[i][0] in BLOCKS), None)
                if index is not None and open_tags[index][0] == "p":
                    leave(index)
            values, bare = _attributes(token[4]) if token[4] else ({}, ())
            kind = _kind(name, values, bare, articles)
            # What is marked inside a line is no wrapper.
            marked = kind in (MARKED, STATED) and name not in INLINE and not asides
            aside = kind != OPEN and not marked
            if marked:
                close()
                marks.append([mark, kind, 0, False])
                mark = len(marks) - 1
            article = name == "article" and kind == OPEN
            main = kind == OPEN and (name == "main" or values.get("itemprop") == "articleBody")
            if (article or main or name == "h1") and not asides and not aside:
                if mark < 0:
                    titled = True
                else:
                    marks[mark][3] = True
            open_tags.append((name, aside, article, main, marked))
            asides, articles, mains, links = asides + aside, articles + article, mains + main, links + (name == "a")
    if not asides:
        text.append(page[at:])
    close()
    is_open = _wrappers(marks, words, titled)
    kept = [(kind, t) for kind, t, inside in found if inside < 0 or is_open[inside]]
    best = max((kind for kind, _ in kept), default=0)
    return [(ARTICLE if kind else PLAIN, t) for kind, t in kept if kind == best]


def runs(streams, sizes):
    """For the token streams of some pages, a hash for each suffix's shortest run of ``RUN_WORDS`` words.

    Returns (page, position, run, blocks in the run); suffixes with too few words have none. ``streams`` are
    arrays of token hashes, ``sizes`` of their words. The suffix array is sorted by prefix doubling to the
    depth of ``RUN_BLOCKS`` tokens, which is as far as a run can reach.
    """
    count = np.array([len(s) for s in streams], dtype=np.int64)
    total = int(count.sum())
    if not total:
        return (np.zeros(0, np.int64),) * 4
    tokens, words = np.concatenate(streams), np.concatenate(sizes)
    page = np.repeat(np.arange(len(streams)), count)
    ends = np.cumsum(count)[page]
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    at = np.arange(total)
    width = 1
    while True:
        follow = np.where(at + width < ends, rank[np.minimum(at + width, total - 1)], 0)
        order = np.lexsort((follow, rank))
        new = np.ones(total, dtype=bool)
        new[1:] = (rank[order][1:] != rank[order][:-1]) | (follow[order][1:] != follow[order][:-1])
        rank[order] = np.cumsum(new)
        width *= 2
        if width >= RUN_BLOCKS or new.all():
            break
    # The run of a suffix: as many tokens as reach RUN_WORDS. Neighbours in the array that agree on
    # them share the run; its hash names it across slices.
    sums = np.append(0, np.cumsum(words))
    reach = np.searchsorted(sums, sums[at] + RUN_WORDS)
    length = reach - at
    good = (reach <= ends) & (length <= RUN_BLOCKS)
    order = order[good[order]]
    new = np.ones(len(order), dtype=bool)
    a, b = order[1:], order[:-1]
    same = length[a] == length[b]
    for step in range(RUN_BLOCKS):
        deep = step < length[a]
        same &= ~deep | (tokens[np.minimum(a + step, total - 1)] == tokens[np.minimum(b + step, total - 1)])
    new[1:] = ~same
    heads = order[new]
    names = np.zeros(len(heads), dtype=np.uint64)
    for step in range(RUN_BLOCKS):
        deep = step < length[heads]
        names[deep] = mix(names[deep] * np.uint64(31) + tokens[heads[deep] + step])
    name = np.zeros(total, dtype=np.uint64)
    name[order] = names[np.cumsum(new) - 1]
    starts = (np.cumsum(count) - count)[page]
    return page[good], (at - starts)[good], name[good], length[good]


def _digest(texts):
    return np.array([xxhash.xxh64_intdigest(t.encode()) for t in texts], dtype=np.uint64)


def _whole(stream):
    """Digest of a page's list of blocks."""
    return mix(stream * np.uint64(3) + np.arange(len(stream), dtype=np.uint64)).sum(dtype=np.uint64)


def _parsed(batch):
    return [blocks(x or "") for x in batch.column("html").to_pylist()]


def _host_runs(batches):
    """Runs of each host in a slice: how many pages have it, and two of their digests."""
    for batch in slices(batches, "html", 4 << 20):
        pages, hosts = _parsed(batch), batch.column("host").to_pylist()
        by_host = {}
        for number, host in enumerate(hosts):
            by_host.setdefault(host, []).append(number)
        out = []
        for host, numbers in by_host.items():
            streams = [_digest([t for _, t in pages[n]]) for n in numbers]
            sizes = [np.array([t.count(" ") + 1 for _, t in pages[n]], dtype=np.int64) for n in numbers]
            whole = np.array([_whole(s) for s in streams], dtype=np.uint64)
            page, _, run, _ = runs(streams, sizes)
            pairs = np.unique(np.column_stack([run, page.astype(np.uint64)]), axis=0)
            kinds, first, many = np.unique(pairs[:, 0], return_index=True, return_counts=True)
            digests = whole[pairs[:, 1].astype(np.int64)]
            if len(kinds):
                low, high = np.minimum.reduceat(digests, first), np.maximum.reduceat(digests, first)
                out.append((host, kinds, many, low, high))
        yield pa.RecordBatch.from_arrays([
            pa.array([h for h, k, *_ in out for _ in range(len(k))], pa.string()),
            *(pa.array(np.concatenate([o[i] for o in out]).view(np.int64) if out else [], pa.int64()) for i in range(1, 5)),
        ], names=["host", "run", "pages", "low", "high"])


def _page_runs(batches):
    """Each page's blocks, and the run that starts at each of them (0: none) with its length."""
    for batch in slices(batches, "html", 4 << 20):
        found = _parsed(batch)
        names, digests = [], []
        for page in found:
            own, size = _digest([t for _, t in page]), np.array([t.count(" ") + 1 for _, t in page], dtype=np.int64)
            _, at, run, length = runs([own], [size])
            names.append([(int(p), int(r), int(n), int(size[p])) for p, r, n in zip(at, run.view(np.int64) if len(run) else run, length)])
            digests.append(int(_whole(own).view(np.int64)))
        yield pa.RecordBatch.from_arrays([
            batch.column("u1"), batch.column("u2"), batch.column("host"),
            pa.array(digests, pa.int64()),
            pa.array([sum(words for *_, words in own) for own in names], pa.int64()),
            pa.array([[dict(at=a, run=r, blocks=b, words=w) for a, r, b, w in own] for own in names],
                     pa.list_(pa.struct([("at", pa.int32()), ("run", pa.int64()), ("blocks", pa.int32()), ("words", pa.int64())]))),
        ], names=["u1", "u2", "host", "digest", "total", "runs"])


def _texts(batches):
    for batch in slices(batches, "html", 4 << 20):
        found = _parsed(batch)
        out = []
        for page, gone in zip(found, batch.column("gone").to_pylist()):
            drop = {at + i for at, many in map(dict.values, gone or []) for i in range(many)}
            out.append("\n\n".join(t for i, (_, t) in enumerate(page) if i not in drop))
        yield pa.RecordBatch.from_arrays([
            *(batch.column(c) for c in batch.schema.names if c not in ("html", "gone")), pa.array(out, pa.string())],
            names=[*(c for c in batch.schema.names if c not in ("html", "gone")), "text"])


def _lower(hits, of):
    """Lower Wilson bound of a share."""
    p, z = hits / of, CONFIDENCE ** 2 / of
    return (p + z / 2 - CONFIDENCE * F.sqrt((p * (1 - p) + z / 4) / of)) / (1 + z)


def _judged(own, shared):
    """The (host, run) of ``shared`` that are surely on most bodies of their host.

    Pages with equal blocks count once. ``own`` has a row for each page, ``shared`` one for each repeated run in it.
    """
    sites = own.filter("total > 0").select("host", "digest").distinct().groupBy("host").agg(F.count("*").alias("distinct_pages"))
    pairs = written(shared.groupBy("host", "digest", "run").agg(
        F.max("total").alias("total"), F.countDistinct("at").alias("times"), F.max("words").alias("words")), "pairs")
    found = pairs.groupBy("host", "run").agg(F.count("*").alias("on")).join(sites, "host")
    common = written(found.filter(F.col("on") > SITE_SHARE * F.col("distinct_pages")).select("host", "run", "distinct_pages"), "common")
    held = pairs.join(common, ["host", "run"])
    pages = written(held.groupBy("host", "digest").agg(
        (F.max("total") - F.sum(F.col("words") * F.col("times")) < OWN_SHARE * F.max("total")).alias("copy")), "page-kinds")
    copies = pages.filter("copy").groupBy("host").agg(F.count("*").alias("copies"))
    hits = held.join(pages.filter("not copy"), ["host", "digest"]).groupBy("host", "run").agg(
        F.count("*").alias("hits"), F.max("distinct_pages").alias("distinct_pages")).join(copies, "host", "left")
    bodies = F.col("distinct_pages") - F.coalesce("copies", F.lit(0))
    return hits.filter(_lower(F.col("hits"), bodies) > SITE_SHARE).select("host", "run")


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row of ``pages``.

    A null or empty page, and one without an article or other text, has an empty text. Pages with null
    ``url`` form a host of their own. Equal rows count as one page of their host, and copies of a page
    as one where repeats are looked for, so a text is never boilerplate of itself.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    keyed = pages.select(
        F.xxhash64("url", "html").alias("u1"), F.hash("url", "html").alias("u2"), "page_id", "url", host.alias("host"), "html")
    sums = keyed.select("host", "html").mapInArrow(
        _host_runs, "host string, run long, pages long, low long, high long")
    runs_of = sums.groupBy("host", "run").agg(
        F.sum("pages").alias("pages"), F.min("low").alias("low"), F.max("high").alias("high"))
    # Found on one page, or on copies of one page only: no repeat.
    repeated = written(runs_of.filter("pages > 1 and low <> high").select("host", "run"), "repeats")
    own = written(keyed.select("u1", "u2", "host", "html").mapInArrow(
        _page_runs, "u1 long, u2 int, host string, digest long, total long, "
        "runs array<struct<at int, run long, blocks int, words bigint>>"), "page-runs")
    started = own.select("u1", "u2", "host", "digest", "total", F.inline("runs"))
    shared = written(started.join(repeated, ["host", "run"]), "shared")
    judged = written(_judged(own, shared), "judged")
    covered = shared.join(judged, ["host", "run"], "left_semi")
    gone = written(covered.select("u1", "u2", "at", "blocks").distinct().groupBy("u1", "u2").agg(
        F.collect_list(F.struct("at", "blocks")).alias("gone")), "gone")
    rows = keyed.join(gone, ["u1", "u2"], "left").select("page_id", "url", "html", "gone")
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    out = rows.mapInArrow(_texts, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
