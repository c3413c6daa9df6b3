"""Words, tokens, HTML and WARC against brute force and exact round trips, with nulls, empty and odd texts."""

import hashlib
import math
import os
import random
import time
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from glyphflow.llm import html_text
from glyphflow.llm.hashing import slices
from glyphflow.llm.html_text import extract, main_text
from glyphflow.llm.pieces import Counts, Ids, load
from glyphflow.llm.queries import tokenizer
from glyphflow.llm.shared import new_folder
from glyphflow.llm.token_count import count_huge, count_tokens
from glyphflow.llm.token_store import cut_places, cuts, merkle, read_store, store_round_trip, write_store
from glyphflow.llm.warc import WarcError, members, parsed, read_warc, round_trip, write_warc

VOCABULARY = "the of and to in that is was he for it with as his on be at by had not extraordinary".split()
ODD = ["", "a  b", " lead", "trail ", "x\n\ny", "I'm don't", "naïvé Ünï", "tab\there", "<|endoftext|> x<|startoftext|>y", "1234 56.7,8 .., a.b", "\n", "a\x1cb c", "日本語 テキスト.", "É. È,", "a\xa0b", " \n a", "It's. 's", "foo.\nBar baz,\nqux \n z", "é ́x", "İstanbul K"]


#: Among others: letters that grow in lower case or compose, marks, conjoining letters, all kinds of white space, parts of special tokens.
SIGNS = ["a", "b", "Z", "é", "İ", "ß", "\u0301", "\u0345", " ", " ", " ", ".", ",", "\n", "\r", "\t", "'", "s", "1", "<|endoftext|>", "<|startoftext|>", "<|", "\x1c", "\x85", "\xa0", "\u2003", "\u2028", "\u3000", "\u1680", "日", "本", "。", "가", "\u1100", "\u1161", "ﬁ", "😀", "\u200b", "ς", "Σ", "-", "!", "ǅ", "\x00", "\x7f", "\u09c7", "\u09be"]


def lib_counts(tokenizer_, texts):
    return [len(x.ids) for x in tokenizer_.encode_batch(texts, add_special_tokens=False)]


def strange(rng, lengths):
    return "".join(rng.choice(SIGNS) for _ in range(rng.choice(lengths)))


@pytest.fixture(scope="module")
def counts():
    return Counts(load(tokenizer("word_bpe_49k.json")), most=10_000)


@pytest.mark.parametrize("together", [1, 50, 1 << 18])
def test_pieces_equal_the_library(counts, monkeypatch, together):
    monkeypatch.setattr("glyphflow.llm.pieces.TOGETHER", together)
    ids = Ids(load(tokenizer("byte_bpe_50k.json")), most=10_000)
    rng = random.Random(1)
    texts = ODD + ["Bİ. " * 10, "Bİ.", "TİPİ, x", None] + [strange(rng, (0, 1, 2, 3, 5, 8, 13, 40)) for _ in range(6000)]
    plain = [t or "" for t in texts]
    expected = [x.ids + [0] for x in ids.tokenizer.encode_batch(plain, add_special_tokens=False)]
    sizes = lib_counts(counts.tokenizer, plain)
    for a, b, data, offsets in slices(pa.array(texts), 1000):
        found = [x[i:j].tolist() for _, _, x, begins in ids.of(data, offsets, 0) for i, j in zip(begins, begins[1:], strict=False)]
        assert found == expected[a:b]
        assert counts.of(data, offsets).tolist() == sizes[a:b]


def test_tokenizers_that_are_not_covered_are_refused(spark):
    with pytest.raises(ValueError, match="proven"):
        Counts(load(tokenizer("byte_bpe_50k.json")))
    with pytest.raises(ValueError, match="proven"):
        Ids(load(tokenizer("word_bpe_49k.json")))
    with pytest.raises(ValueError, match="proven"):
        count_tokens(spark.range(1).selectExpr("id doc_id", "'x' text"), tokenizer("byte_bpe_50k.json"))


@pytest.mark.parametrize("chunk,overlap", [(40, 8), (64, 4), (200, 16)])
def test_spliced_chunks_equal_the_whole(counts, chunk, overlap):
    rng = random.Random(chunk)
    texts = [" ".join(rng.choice(words) for _ in range(120)) for words in (["the", "of", "antidisestablishment", "é1", "x" * 90], ["a"], ["y" * 300], ["日本語。", "テキスト、"])]
    texts += ["日本語の文。" * 80, "x" * 900, "日" * 700, *(strange(rng, (300, 500)) for _ in range(150))]
    assert [count_huge(counts.tokenizer, t, chunk, overlap) for t in texts] == lib_counts(counts.tokenizer, texts)


def test_a_text_without_white_space_is_spliced(counts):
    sizes = []

    class Spy:
        def encode(self, text, **how):
            sizes.append(len(text))
            return counts.tokenizer.encode(text, **how)

    text = "日本語の文章です。" * 4000
    assert count_huge(Spy(), text, 2000, 64) == lib_counts(counts.tokenizer, [text])[0] and max(sizes) <= 2000 and len(sizes) > 15


@pytest.mark.parametrize("huge", [50, 16_384])
def test_count_tokens(spark, huge):
    rng = random.Random(huge)
    texts = ["Hello world", None, "", "Hello world", "Bİ. " * 10, "日本。" * 90, *(strange(rng, (0, 5, 49, 50, 51, 300)) for _ in range(120))]
    df = spark.createDataFrame([(None if i == 2 else i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    got = [(r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in count_tokens(df, tokenizer("word_bpe_49k.json"), limit=2, huge=huge).collect()]
    plain = [t or "" for t in texts]
    assert got == [(None if i == 2 else i, len(t.encode()), n, n > 2) for i, (t, n) in enumerate(zip(plain, lib_counts(load(tokenizer("word_bpe_49k.json")), plain), strict=True))]
    assert count_tokens(df.limit(0), tokenizer("word_bpe_49k.json")).count() == 0


def test_store_round_trip(spark):
    words = "the of and to in that is was he for it with as his on be at by had not".split()
    rng = random.Random(2)
    shared = " ".join(rng.choice(words) for _ in range(5000))
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 900))) + (shared if i % 3 == 0 else "")) for i in range(40)] + [(41, None), (42, ""), (43, shared), (43, shared), (None, "x")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    lib = load(tokenizer("byte_bpe_50k.json"))
    start, expected = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [0]
        expected.append((i, start, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))))
        start += len(ids)
    got = [tuple(r) for r in store_round_trip(df, tokenizer("byte_bpe_50k.json")).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert sorted(got, key=lambda r: r[1]) == expected
    assert store_round_trip(df.limit(0), tokenizer("byte_bpe_50k.json")).count() == 0


def test_packs_roll(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(VOCABULARY) for _ in range(rng.randint(0, 600)))) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(20)] + [rows[3]] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    plain = sorted(tuple(r) for r in store_round_trip(df, tokenizer("byte_bpe_50k.json")).collect())
    monkeypatch.setattr("glyphflow.llm.token_store.PACK_CHUNKS", 5)
    store = write_store(df, tokenizer("byte_bpe_50k.json"))
    assert store["manifest"].count() > 10 and sorted(tuple(r) for r in read_store(store, 2).collect()) == plain


def test_packs_begin_with_equal_rows(spark, monkeypatch):
    monkeypatch.setattr("glyphflow.llm.token_store.PACK_CHUNKS", 5)
    df = spark.createDataFrame([(i, "x y") for i in (3, 5, 7) for _ in range(23)] + [(None, "z")] * 12, "doc_id long, text string").repartition(3)
    got = sorted(tuple(r)[:3] for r in store_round_trip(df, tokenizer("byte_bpe_50k.json")).select("start", "n_tokens", "doc_id").collect())
    assert [i for *_, i in got] == [None] * 12 + [i for i in (3, 5, 7) for _ in range(23)]
    assert all(a + n == b for (a, n, _), (b, *_) in zip(got, got[1:], strict=False))


def test_packs_are_written_without_what_the_tokenizer_remembers(spark):
    def remembered(batches):
        from glyphflow.llm.token_store import encoder

        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": [encoder.cache_info().currsize]})

    sc, parts = spark.sparkContext, spark.conf.get("spark.sql.shuffle.partitions")
    df = spark.range(50).select("id", F.concat(F.lit("a text "), "id").alias("text")).coalesce(1)
    sc.environment["GLYPHFLOW_TEST"] = "a worker of its own"  # one task at a time: all run in the same worker
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        write_store(df, tokenizer("byte_bpe_50k.json"), "id")
        assert spark.range(1).coalesce(1).mapInArrow(remembered, "n long").first()["n"] == 0
    finally:
        del sc.environment["GLYPHFLOW_TEST"]
        spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_store_is_read_by_the_names_that_tasks_returned(spark):
    df = spark.createDataFrame([(i, f"text {i % 7}") for i in range(40)], "doc_id long, text string").repartition(3)
    store = write_store(df, tokenizer("byte_bpe_50k.json"))
    folder = os.path.dirname(store["manifest"].first()["pack"].removeprefix("file:"))
    packs = {r["pack"].rpartition("/")[2] for r in store["manifest"].collect()}
    names = {p.removeprefix("pack-").removesuffix(".bin") for p in packs}
    assert set(os.listdir(folder)) == packs | {f"{kind}-{n}.parquet" for kind in ("recipes", "index") for n in names}
    for kind in ("recipes", "index"):  # a task that failed has left a part of a file
        with open(f"{folder}/{kind}-0.parquet", "wb") as f:
            f.write(b"PAR1")
    assert read_store(store, 2).count() == 40


def test_page_ids_of_any_kind(spark):
    df = spark.createDataFrame([("a\r\nb: c", "u", "x" * 200), ("é %41", None, "x" * 200), (None, "u", "y")], "page_id string, url string, html string")
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in round_trip(spark, df).collect()}
    assert got == {"a\r\nb: c": ("response", None), "é %41": ("revisit", "a\r\nb: c"), None: ("response", None)}


def test_chunks_and_merkle():
    import numpy as np

    ids = np.random.default_rng(1).integers(0, 50_000, 60_000).astype(np.uint32)
    chunks = lambda x: cuts(cut_places(x), len(x))
    ends = chunks(ids)
    assert ends[-1] == len(ids) and all(b - a <= 8192 for a, b in zip([0, *ends], ends, strict=False))
    both = cut_places(np.concatenate([ids[:5000], ids]))
    assert cuts(both[both > 5000] - 5000, len(ids)) == ends
    moved = chunks(np.concatenate([ids[:100], ids]))
    assert len({e - 100 for e in moved} & set(ends)) > 0.8 * len(ends)
    assert merkle([b"a"]) == b"a" and merkle([b"a", b"b"]) == hashlib.sha256(b"ab").digest() and merkle([]) == hashlib.sha256(b"").digest()


def test_warc_round_trip(spark):
    big = "é<p>" * 60
    rows = [(5, "http://a/ü b", big), (3, None, big), (9, "u", "short"), (1, "u", "short"), (7, "u", None), (8, "", ""), (3, None, big), (None, "x", "n" * 200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((tuple(r) for r in round_trip(spark, df).collect()), key=repr)
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    size = lambda t: len((t or "").encode())
    expected = [(i, size(h), digest(h), "response", None) for i, _, h in rows if i not in (5, 3)] + [(3, size(big), digest(big), "response", None), (3, size(big), digest(big), "revisit", 3), (5, size(big), digest(big), "revisit", 3)]
    assert got == sorted(expected, key=repr)
    assert round_trip(spark, df.limit(0)).count() == 0


def test_warc_reader_sees_damage(spark):
    manifest = write_warc(spark.createDataFrame([(1, "u", "x" * 500)], "page_id long, url string, html string"), new_folder(spark, "warc-test"))
    assert read_warc(manifest, payloads=True).first()["payload"] == bytearray(b"x" * 500)
    path = manifest.first()["file"].removeprefix("file:")
    with open(path, "rb") as f:
        record = next(members(f))
    for bad in (record.replace(b"xxxx", b"xxxy", 1), record[:-1], record + b"z", record.replace(b"WARC/", b"CRAW/", 1)):
        with pytest.raises(WarcError):
            parsed(bad)
    with open(path, "rb") as f:
        data = f.read()
    with open(path, "wb") as f:
        f.write(data[:-20])
    with pytest.raises(Exception, match="ends inside"):
        read_warc(manifest).collect()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="has-sidebar">
<nav><ul><li><a href=/>Home</a><li><a href=/x>News</a></ul></nav><div class="cookie-notice">We use cookies</div>
<%s><h1>Title &amp; more</h1><p>First   paragraph with <b>bold</b> text&nbsp;and &eacute;t&eacute; that is long enough to matter.
<p>Second one<br>after a break, also with some length to it, more than a menu has.<div class="ad">Buy now</div>
<ul><li>One item<li>Two items</ul><form><input value=q><button>Send</button></form></%s>
<div id="comments"><p>Reader says a long thing that goes on for a while and on.</p></div><aside>Related</aside><footer>&copy; Site</footer></body></html>"""


@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_main_text(tag):
    assert main_text(PAGE % (tag, tag)).split("\n\n") == [
        "Title & more", "First paragraph with bold text and été that is long enough to matter.", "Second one after a break, also with some length to it, more than a menu has.", "One item", "Two items",
    ]


LONG = "A sentence of an article that is long enough to be told from a menu, with several clauses. " * 3


@pytest.mark.parametrize(
    "open_tag,stays",
    [
        ('div style="overflow:hidden"', True), ("div style='overflow:hidden'", True), ("div data-hidden", True), ('div aria-hidden="false"', True), ('div title="a hidden gem"', True), ('div title="class=ad"', True),
        ('div data-id="search"', True), ("div data-x=id=search", True), ('div title = "x id=menu" lang=en', True), ('div title="it\'s hidden" class=story', True), ('div class=story class=ad', True),
        ('section id="social-effects"', True), ('section id="search"', True), ('div class="section" id="related-work"', True), ('section class="share"', False), ('section id="comments"', False), ('section id="related_comments"', False),
        ("div hidden", False), ('div HIDDEN=""', False), ('div title="x" hidden="until-found"', False), ("div id=search", False), ("div CLASS='x social-share'", False), ('div lang=en role="search"', False), ('div style="a:b" class="ad"', False), ("div class = menu", False),
    ],
)
def test_noise_is_named_by_real_attributes(open_tag, stays):
    tag = open_tag.split()[0]
    page = f"<body><nav><a href=/>Home</a></nav><article><p>{LONG}</p><{open_tag}><p>Inner text.</p></{tag}><p>{LONG}</p></article></body>"
    assert main_text(page).split("\n\n") == [LONG.strip(), *["Inner text."] * stays, LONG.strip()]


def test_links_and_headings_of_an_article_stay():
    page = f'<body><article><p>{LONG} See <a href="/places/hidden-valley">the valley</a> or <a href="/x?id=search">find it</a>.</p><h2 id="related-work">Related work</h2><h3 id=search>Search</h3><h2 class="ad">Buy</h2><p>{LONG}</p></article></body>'
    assert main_text(page).split("\n\n") == [f"{LONG}See the valley or find it.", "Related work", "Search", LONG.strip()]
    page = f'<body><nav><a href=/>Home</a></nav><div style="overflow:hidden"><p>{LONG}</p><p>{LONG}</p></div></body>'
    assert main_text(page).split("\n\n") == [LONG.strip()] * 2


@pytest.mark.parametrize(
    "page",
    [
        "<main><article><p>%s</p></article><article><p>%s</p></article><article><p>%s</p></article></main>", "<article><p>%s</p></article><article><p>%s</p></article><article><p>%s</p></article>",
        "<div><p>%s</p></div><div><p>%s</p></div><div><p>%s</p></div>", "<main><div><article><p>%s</p></article><article><p>%s</p></article></div><article><p>%s</p></article></main>",
    ],
)
def test_all_parts_of_a_page_stay(page):
    parts = [f"{x} part. {LONG}".strip() for x in ("First", "Second", "Third")]
    first = "</p><p>".join([parts[0]] * 6)  # its density sum is the highest, over that of its parent
    menu = "<ul><li><a href=/>Home page</a><li><a href=/x>All the news</a></ul>"
    assert main_text(f"<body><nav>{menu}</nav>{page % (first, *parts[1:])}<div class=ad>Buy now</div><footer>Site</footer></body>").split("\n\n") == [parts[0]] * 5 + parts
    one = f"<body><div>{menu}</div><article><p>{LONG}</p><p>{LONG}</p></article><div><p>Get our letter.</p></div></body>"
    assert main_text(one).split("\n\n") == [LONG.strip()] * 2


def test_names_say_nothing_of_containers_and_paragraphs():
    assert main_text(f"<body><div class='content no-sidebar'><p>{LONG}</p></div></body>") == LONG.strip()
    assert main_text(f"<body><div id='main' class='layout with-sidebar'><p>{LONG}</p></div><nav><a href=/>x</a></nav></body>") == LONG.strip()
    assert main_text(f"<body><div class=widget><p>{LONG}</p><p>{LONG}</p></div><div class=widget>Other.</div></body>").split("\n\n") == [LONG.strip()] * 2
    assert main_text(f"<body><div><p>{LONG}</p><p class=search>How to search.</p><p class=ad>Buy.</p></div></body>").split("\n\n") == [LONG.strip(), "How to search."]
    comments = f"<div class=comments><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>"
    assert main_text(f"<body><div><p>{LONG}</p></div>{comments}</body>") == LONG.strip()


def random_page(rng, depth=0):
    """A tree of (tag, children) without an article; texts are strings."""
    out = []
    for _ in range(rng.choice([1, 2, 3, 5])):
        kind = rng.choice(["div", "section", "p", "p", "menu", "h2", "text"] if depth < 4 else ["p", "h2"])
        words = lambda n: " ".join(rng.choice(VOCABULARY) for _ in range(rng.randint(1, n)))
        link = ("a", [words(2)])
        if kind in ("div", "section"):
            out.append((kind, random_page(rng, depth + 1)))
        elif kind == "menu":
            out.append(("ul", [("li", [link]) for _ in range(rng.randint(1, 6))]))
        elif kind == "text":
            out.append(words(8))
        else:
            out.append((kind, [words(60 if kind == "p" else 4), *rng.choice([[], [link], [("b", [words(3)]), words(9)]])]))
    return out


def rendered(node):
    return node if isinstance(node, str) else f"<{node[0]}>{' '.join(map(rendered, node[1]))}</{node[0]}>"


def plain_text(body):
    """What main_text gives for such a page, straight from the definitions; each figure is found by walking the subtree."""
    size = lambda x: len(x.strip()) if isinstance(x, str) else sum(map(size, x[1]))
    below = lambda x: [y for z in x[1] if not isinstance(z, str) for y in (z, *below(z))]
    links = lambda x: [y for y in (x, *below(x)) if y[0] == "a"]

    def density(x):
        c, t, lc, lt = size(x), max(1, len(below(x))), sum(map(size, links(x))), len(links(x))
        if not c:
            return 0.0
        share = sum(map(size, links(body))) / max(1, size(body))
        base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
        return c / t * math.log(c / max(1, lc) * (t / max(1, lt))) / max(1.0, math.log(base))

    total = lambda x: sum(density(y) for y in x[1] if not isinstance(y, str))
    above = {id(y): x for x in (body, *below(body)) for y in x[1]}
    of_links = lambda x: x[0] in ("div", "section", "ul") and 2 * sum(map(size, links(x))) > size(x)
    peak = lambda x: max([x, *below(x)], key=lambda y: -1.0 if of_links(y) else total(y))
    path = [peak(body)]
    while path[-1] is not body:
        path.append(above[id(path[-1])])
    least, marked = min(map(density, path)), set()

    def mark(x):
        if of_links(x) and not any(x is y for y in path):
            return
        if density(x) >= least:
            top = peak(x)
            while top[0] not in ("div", "section", "body") and above[id(top)] is not body:
                top = above[id(top)]
            marked.add(id(top))
        for y in x[1]:
            if not isinstance(y, str) and id(x) not in marked and id(y) not in marked:
                mark(y)

    mark(body)
    out, held = [], []

    def end():
        if held and (t := " ".join(" ".join(held).split())):
            out.append(t)
        held.clear()

    def put(x, content):
        if isinstance(x, str):
            held.extend([x] * content)
            return
        if content and id(body) in marked and x[0] in ("div", "section", "ul") and len(links(x)) >= 3 and 3 * sum(map(size, links(x))) >= 2 * size(x):
            return
        content = content or id(x) in marked
        beside = not content and any(id(y) in marked for y in x[1])
        block = x[0] not in ("a", "b")
        if block:
            end()
        for y in x[1]:
            put(y, content or not isinstance(y, str) and beside and y[0] in ("p", "h2", "ul", "a", "b") and 2 * sum(map(size, links(y))) <= size(y))
        if block:
            end()

    put(body, id(body) in marked)
    return "\n\n".join(out)


def test_main_text_equals_a_plain_version():
    rng, found = random.Random(12), 0
    for _ in range(300):
        body = ("body", random_page(rng))
        text = main_text(rendered(body))
        assert text == plain_text(body), rendered(body)
        found += 0 < len(text) < len("\n\n".join(x for x in [rendered(body)]))
    assert found > 250


def test_blocks_of_links_beside_the_content_go():
    side = "<div id=side><h3>Popular posts</h3><ul>" + "".join(f"<li><a href=/{i}>A popular post with a long title {i}</a></li>" for i in range(9)) + "</ul><p>Subscribe today!</p></div>"
    for main in (f"<div id=wrap><div id=content><h1>Title</h1><p>{LONG}</p><p>Short.</p><ul><li>One</li></ul></div>{side}</div>", f"<main><h1>Title</h1><p>{LONG}</p><p>Short.</p><ul><li>One</li></ul></main>{side}"):
        assert main_text(f"<body>{main}</body>").split("\n\n") == ["Title", LONG.strip(), "Short.", "One"]
    assert main_text(f"<body><main><h1>Note</h1><p>Tiny.</p></main>{side}</body>") == "Note\n\nTiny."


def test_densities_decide(monkeypatch):
    menu = "<div><ul>" + "<li><a href=/x>One of many links</a> and</li>" * 30 + "</ul></div>"
    page = f"<body>{menu}<div><p>{LONG}</p><p>{LONG}</p></div>{menu}</body>"
    assert main_text(page).split("\n\n") == [LONG.strip()] * 2
    plain = html_text.composite
    monkeypatch.setattr(html_text, "composite", lambda *how: -plain(*how))
    assert LONG.strip() not in main_text(page)


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "x", "<div></x>" * 100_000, "<p><b>" * 50_000 + "x", "<ul><li>" * 50_000, "<b>" * 100_000 + "<p>x" * 1000])
def test_deep_pages_take_linear_time(page):
    began = time.process_time()
    assert main_text(page).startswith("x" if "x" in page.replace("</x>", "") else "")
    assert time.process_time() - began < 4  # quadratic time would be minutes


def test_pages_of_all_kinds(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<article><p>cut off in the mid"), (4, "u", "plain text"), (5, "u", "<<<>>> <p <b"), (6, "u", "<div>" * 3000 + "deep" + "</div>" * 3000), (7, "u", "plain text"), (7, "u", "plain text")]
    df = spark.createDataFrame([(*r, "a", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    assert extract(df).count() == len(rows) and extract(df.limit(0)).count() == 0
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in extract(df).collect()}
    assert got[1] == got[2] == ("", 0) and got[3] == ("cut off in the mid", 18) and got[4] == ("plain text", 10) and got[6] == ("deep", 4)
