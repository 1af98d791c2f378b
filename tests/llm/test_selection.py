"""Extraction, filter audit and resampling against brute force."""

import hashlib
import html
import math
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pytest

from statweave.llm import filter_audit, importance
from statweave.llm.html_content import extracted, main_text, read_page
from statweave.sources.tables import table

# ---- extraction


def plain_article(source: str) -> str:
    """The article element of the given pages, by patterns that fit only them."""
    inner = re.search("<article>(.*)</article>", source, re.S).group(1)
    parts = re.split("</?(?:p|h1)>", re.sub("<br>", " ", re.sub("</?b>", "", inner)))
    return "\n\n".join(t for t in (" ".join(html.unescape(p).split()) for p in parts) if t)


def test_pages_equal_their_article(spark, sf):
    pages = table(spark, sf, "pages")
    found = {r.page_id: r.text for r in extracted(pages).collect()}
    assert found == {r.page_id: plain_article(r.html) for r in pages.collect()}


PARAGRAPHS = [
    "The council met on Tuesday, and after a long debate it agreed to widen the old bridge.",
    "Nobody had expected this; the vote, held late at night, was close.",
    "Short line.",
    "Work begins in spring, the mayor said, and should end before the first frost of the year.",
    "Traffic will be led over the northern road, which is closed to lorries until then.",
]
TITLE = "A wider bridge"
EXPECTED = "\n\n".join([TITLE, *PARAGRAPHS])
BODY = f"<h1>{TITLE}</h1>" + "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
NOISE_BEFORE = (
    '<header><a href="/">Daily</a><p>All the news of the day, every day, since 1890.</p></header>'
    '<nav><ul><li><a href="/a">Home</a><li><a href="/b">Sport</a></ul></nav>'
    '<div class="cookie-notice"><p>We use cookies, as everyone does, to make this page better for you.</p></div>'
)
NOISE_AFTER = (
    '<aside><h2>More</h2><p>Ten things to know about bridges, and why the seventh will surprise you.</p></aside>'
    '<div id="sidebar"><p>Weather: rain, wind and some sun, with more rain later in the week.</p></div>'
    '<form><label>Mail</label><input><p>Sign up, and never miss a story of ours again.</p></form>'
    '<section class="comments"><h3>Comments</h3><p>I live there, and I think, honestly, that it is far too wide already.</p></section>'
    "<footer>&copy; Daily, all rights reserved.</footer><script>if (a < b) { x = '<p>no</p>' }</script>"
)


@pytest.mark.parametrize(
    "wrap",
    [
        "<article>{}</article>",
        "<main>{}</main>",
        '<div id="content">{}</div>',
        '<div class="page-with-sidebar"><div class="post">{}</div></div>',
        "<div><div>{}</div></div>",
        '<div role="main">{}</div>',
        '<table><tr><td class="left"><a href="/x">x</a><td>{}</table>',
        "<ARTICLE CLASS=long><section>{}</section></ARTICLE>",
        '<div class="site sidebar-right"><div class="row"><main>{}</main></div></div>',
        '<div class="columns"><div class="sidebar"><p>Elsewhere, a bridge fell, and nobody was hurt.</p></div><article>{}</article></div>',
    ],
)
def test_layouts(wrap):
    page = f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>{NOISE_BEFORE}{wrap.format(BODY)}{NOISE_AFTER}</body></html>"
    assert main_text(page) == EXPECTED


def test_inside_an_article():
    page = """<article class="post"><header><h1>Title</h1><div class="share">Share this</div></header>
      <p>One &amp; two&nbsp;three &lt;b&gt; &#233; &eacute x<br>next   line
      <p>Unclosed <b>bold <i>text</b>, more
      <ul><li>first<li><a href="#">second</a></ul>
      <blockquote>Quote</blockquote><table><tr><td>a<td>b</table><pre>x
        y</pre><!-- <p>hidden</p> --><p hidden>gone</p><p style="display: none">gone</p>
      <div class="ad">Buy</div><form>Mail</form><nav>menu</nav><footer>by</footer></article>"""
    assert main_text(page).split("\n\n") == [
        "Title", "One & two three <b> é é x next line", "Unclosed bold text, more", "first", "second", "Quote", "a", "b", "x y",
    ]


def test_odd_pages(spark):
    assert main_text(None) == main_text("") == main_text("<nav>Home</nav><footer>x</footer>") == ""
    assert main_text("just a line, with no tag") == "just a line, with no tag"
    assert main_text("<article><p>one</p><p>two</article") == "one\n\ntwo"
    assert main_text("<article><p>a < b and 3<4</p><p>x <em") == "a < b and 3<4\n\nx"
    assert main_text('<article><p title="a>b">c</p><script>never closed') == "c"
    assert main_text("<article><p><a href='/'>all of it a link</a></p></article>") == "all of it a link"
    long = "<article>" + "<p>word, word" * 40_000 + '<a b="' * 2000
    assert main_text(long).count("word, word") == 40_000
    deep = "<div>" * 3000 + "<p>down here, deep below everything else.</p>" + "</div>" * 3000
    assert main_text(deep) == "down here, deep below everything else."
    rows = [(1, "<p>a b, c.</p>", "x"), (1, "<p>a b, c.</p>", "x"), (2, None, None), (None, "", "z")]
    df = spark.createDataFrame(rows, "page_id long, html string, _main string")
    found = extracted(df)
    assert found.columns == ["page_id", "_main", "text"]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(
        map(str, [(1, "x", "a b, c."), (1, "x", "a b, c."), (2, None, ""), (None, "z", "")])
    )
    assert extracted(df.limit(0)).count() == 0


def test_paths_name_classes_and_close_elements():
    blocks = read_page('<div class="b c"><p>one<p>two<div>three</div>four</div>five').blocks
    assert [(b.text, b.element.path) for b in blocks] == [
        ("one", "/div.b/p"), ("two", "/div.b/p"), ("three", "/div.b/div"), ("four", "/div.b"), ("five", ""),
    ]


# ---- filter audit


def fails(text: str) -> set[str]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = {"A"} if len(words) < 50 else set()
    found |= {"B"} if 100 * len(set(words)) < 65 * len(words) else set()
    found |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else set()
    return found | ({"D"} if re.search("[#$%&*|]", text) else set())


def brute_audit(docs, labels):
    """Rows (part, order, step, kept, removed, redundant, unique, good, toxic, shapley) by walking every order."""
    good = {k for k, q, _ in labels if k is not None and q == 1}
    toxic = {k for k, _, t in labels if k is not None and t == 1}
    order_of = lambda k: (k is None, k or 0)
    least = {}
    for k, t, _ in docs:
        least[t or ""] = min(least.get(t or "", (2, 0)), order_of(k))
    judged = [(k, p or "", fails(t or "") | ({"E"} if order_of(k) > least[t or ""] else set())) for k, t, p in docs]
    rows, total = {}, {}
    for part in {p for _, p, _ in judged}:
        own = [(k, f) for k, p, f in judged if p == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [(k, f) for k, f in left if letter in f]
                failing = sum(letter in f for _, f in own)
                left = [(k, f) for k, f in left if letter not in f]
                rows[part, order, step] = (
                    len(left), len(gone), failing - len(gone), sum(f == {letter} for _, f in own),
                    sum(k in good for k, _ in gone), sum(k in toxic for k, _ in gone),
                )
                total[part, letter] = total.get((part, letter), 0) + len(gone)
    return {(*key, *row, total[key[0], key[1][key[2] - 1]]) for key, row in rows.items()}


@pytest.mark.parametrize("block_bytes", [200, 1 << 20])
def test_audit_equals_brute_force(spark, block_bytes):
    rng = random.Random(3)
    lead = "Terms and conditions apply to every page of this site and to all of its readers. " * 4
    texts = [lead + " ".join(f"w{rng.randrange(99)}" for _ in range(rng.choice([3, 40, 80]))) + rng.choice(["", "", " #", " TITLE"]) for _ in range(25)]
    texts += [None, "", " ", "x", lead, "short", "\x00a", "ü" * 30]
    docs = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice([None, "", "a", "b"])) for _ in range(150)]
    docs += [(500 + i % 7, texts[0], "hot") for i in range(120)] + [(3, "same row", "a")] * 4
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(0, 60, 2)] + [(4, 1, 0), (None, 1, 1), (503, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = filter_audit.audit(df, known, block_bytes=block_bytes)
    assert {tuple(r) for r in found.collect()} == brute_audit(docs, labels)
    assert found.count() == 600 * 4


def test_audit_of_empty_tables_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "a", "s", "m"), (2, "a", "s", "m")], "doc_id long, text string, _part string, _mask string")
    known = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(df.limit(0), known, part="_part").count() == 0
    first = filter_audit.audit(df, known, part="_part").where("filter_order = 'EABCD' AND step = 1").first()
    assert (first.part, first.kept, first.removed, first.unique_fails) == ("s", 1, 1, 0)
    flags = filter_audit.duplicate_flags(df)
    assert sorted(map(tuple, flags.collect())) == [(1, False, 1), (2, True, 1)]


def test_trie_holds_every_text():
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(12))).encode() for _ in range(400)]
    texts += [b"a" * 200_000, b"a" * 200_000 + b"b", b"a" * 199_999]
    groups = list(filter_audit.equal_texts(texts, list(range(len(texts)))))
    assert sorted(r for least, others in groups for r in least + others) == list(range(len(texts)))
    for least, others in groups:
        assert len({texts[r] for r in least + others}) == 1 and least == [min(least + others)]
    assert len(groups) == len(set(texts))


# ---- resampling


def test_crc_matrices_equal_zlib():
    rng = random.Random(1)
    features = [bytes(rng.randrange(256) for _ in range(rng.randrange(40))) for _ in range(500)] + [b"x" * 4096, b"y" * 5000, b""]
    assert importance.crc32(features).tolist() == [zlib.crc32(f) for f in features]
    assert importance.crc32([]).tolist() == []


def features_of(text, grams):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + n]) for n in range(1, grams + 1) for i in range(len(words) - n + 1)]
    return words, [zlib.crc32(r.encode()) for r in runs]


def brute_scores(docs, target, grams, buckets, seed):
    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    for _, text in docs:
        np.add.at(s, [c % buckets for c in features_of(text, grams)[1]], 1)
    for text in target:
        np.add.at(t, [c % buckets for c in features_of(text, grams)[1]], 1)
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + buckets) / ((a + 1) * (t.sum() + buckets)))) for a, b in zip(s.tolist(), t.tolist())]
    rows = []
    for key, text in docs:
        words, crcs = features_of(text, grams)
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[c % buckets] for c in crcs)
        rows.append((key, len(words), len(crcs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    return rows


@pytest.mark.parametrize("grams", [1, 2, 3])
def test_resampling_equals_brute_force(spark, grams):
    rng = random.Random(grams)
    word = lambda: rng.choice(["Ab", "c", "ünï", "d9", "x" * 5000, "e", "--", "f,g"])
    docs = [(k, " ".join(word() for _ in range(rng.randrange(30)))) for k in range(60)] + [(None, "a b c"), (7, None), (8, ""), (9, " .")]
    target = ["Ab c Ab c e", None, "", "d9 zz"]
    df = spark.createDataFrame([(k, t, 1) for k, t in docs], "doc_id long, text string, _row int").repartition(4)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    options = dict(grams=grams, buckets=50, seed="s", least_words=5, percent=30)
    found = importance.importance_report(df, wanted, **options).collect()
    brute = brute_scores(docs, target, grams, 50, "s")
    key = lambda r: tuple((v is None, v or 0) for v in r)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in found), key=key) == sorted(((k, n, w, s) for k, _, n, w, s in brute), key=key)
    order = sorted((r for r in brute if r[1] >= 5), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = order[: 30 * len(order) // 100]
    assert [(r.doc_id, r.rank) for r in sorted((r for r in found if r.rank), key=lambda r: r.rank)] == [(r[0], i) for i, r in enumerate(drawn, 1)]
    kept = importance.resample(df, wanted, **options)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in drawn)


def test_resampling_of_repeated_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b c")] * 10 + [(2, "d e f")], "doc_id long, text string")
    none = df.select("text").limit(0)
    found = importance.importance_report(df, none, least_words=1, percent=50).collect()
    assert len(found) == 11 and sorted(r.rank for r in found if r.rank) == [1, 2, 3, 4, 5]
    assert len({(r.doc_id, r.weight, r.score) for r in found}) == 2
    assert importance.importance_report(df.limit(0), df).count() == 0
    assert importance.resample(df.limit(0), none).count() == 0
