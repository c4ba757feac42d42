import math
import random
import re
import time

import pytest

from scolaria.llm import language_id as lid
from scolaria.llm.html_text import all_blocks, blocks_of, main_text, suffix_array, unique_runs

ARTICLE = (
    "<!DOCTYPE html><html lang=en><head><title>T &amp; t</title><script>var a='</p><article>';</script><style>p{}</style></head>"
    "<body class='page with-sidebar'><header><h1>Site</h1></header><nav><ul><li>Home<li>About</ul></nav><!-- <p>hidden --><div class='ad'>Buy</div>"
    "<article><header><h1>Title  of\n it</h1></header><p><b>First &lt;b&gt; block.<br>more<p>Second&nbsp;block &copy; <a href='x>y'>link</a>.</p>"
    "<aside><p>See also</p></aside><div class='share-buttons'>Tweet</div><form><p>Mail</p></form><ul><li>item one<li>item two</ul>"
    "<table><tr><td>a<td>b</tr></table><figure><img alt='no'><figcaption>caption</figcaption></figure>"
    "<section id='comments'><p>Nice post</p></section><footer>tags</footer><p>Last</p></article><p>beside</p><footer>&copy; me</footer></body></html>"
)


def test_article_without_furniture():
    article, loose = blocks_of(ARTICLE)
    assert article == ["Title of it", "First <b> block. more", "Second block © link.", "item one", "item two", "a", "b", "caption", "Last"]
    assert loose == ["beside"]


@pytest.mark.parametrize(
    ("page", "article", "loose"),
    [
        (None, [], []),
        ("", [], []),
        ("plain &amp text", [], ["plain & text"]),
        ("a < b <3 and <", [], ["a < b <3 and <"]),
        ("<p>one<p>two <scr", [], ["one", "two"]),
        ("<article><p>cut &am", ["cut &am"], []),
        ("<div id=cookie-notice><p>x</div><div>kept</div></div></p>", [], ["kept"]),
        ("<main><p>m</main><p>n", ["m"], ["n"]),
        ("<div role='main'>r<div hidden>h</div></div>", ["r"], []),
        ("<article><script>if (a<b) '</p>'</script>x<script>open", ["x"], []),
        ('<p title="a>b">q</p><p title="open>r</p>', [], ["q", "r"]),
        ("<article>a<!-- never closed <p>b", ["a"], []),
        ("<ARTICLE><P>Up</P></ARTICLE>", ["Up"], []),
        ("<article>" * 3 + "deep" + "</article>" * 5 + "x", ["deep"], ["x"]),
        ("<" * 3000, [], ["<" * 3000]),
        ("<p " + "a='" * 3000, [], []),
    ],
)
def test_odd_markup(page, article, loose):
    assert blocks_of(page) == (article, loose)


def test_given_pages(spark, sf_dir):
    """Every block of the test pages' articles, taken out by plain patterns that fit these pages only."""
    import html

    from scolaria.llm.queries import QUERIES

    want = {}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        inside = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", part)).split()) for part in re.split(r"</?p>|</?h1>", inside)]
        want[r.page_id] = "\n".join(filter(None, blocks))
    got = {r.page_id: (r.text, r.n_chars) for r in QUERIES["op9_html_text"](spark, sf_dir).collect()}
    assert got == {i: (text, len(text)) for i, text in want.items()}


def stream(blocks):
    return ["\n", *(token for block in blocks for token in [*block.split(" "), "\n"])]


def heads(tokens, length):
    """(place, head) of every place: the whole block that starts there, if it is short, else the next tokens."""
    for i in range(len(tokens) - 1):
        window = tokens[i : i + length]
        if tokens[i] == "\n" and "\n" in window[1:]:
            yield i, tuple(window[: window.index("\n", 1) + 1])
        elif len(window) == length:
            yield i, tuple(window)


def brute_runs(pages, length):
    """The texts of pages, what stands on other contents of a host found by comparing all pairs of places."""
    read = []
    for page_id, url, page in pages:
        article, loose = blocks_of(page)
        host = (re.match(r"[a-z]+://([^/]*)", url or "") or [None, ""])[1]
        read.append((page_id, host, article, loose, stream(loose) if loose else []))
    out = []
    for page_id, host, article, loose, tokens in read:
        covered = set()
        for i, head in heads(tokens, length):
            contents = {tuple(others) for _, other_host, _, _, others in read if other_host == host and any(found == head for _, found in heads(others, length))}
            if len(contents) >= (2 if len(head) == length else 3):
                covered |= set(range(i, i + len(head)))
        blocks, place = [], 1
        for block in loose:
            words = block.split(" ")
            kept = [w for k, w in enumerate(words, place) if k not in covered]
            place += len(words) + 1
            blocks += [" ".join(kept)] if kept else []
        out.append((page_id, "\n".join(article) if article else "\n".join(blocks)))
    return sorted(out, key=str)


def test_repeats_of_a_host(spark):
    menu, legal = " ".join(f"menu{i}" for i in range(12)), " ".join(f"legal{i}" for i in range(11))
    pages = [
        (1, "http://a.com/1", f"<body><div>{menu}</div><div>unique one</div><div>{legal} 2024</div>"),
        (2, "http://a.com/2", f"<body><div>{menu} extra</div><div>text of two</div><div>{legal}</div>"),
        (3, "http://b.com/1", f"<body><div>{menu}</div>"),
        (4, "http://b.com/2", f"<article><p>{menu}</p></article>"),
        (5, "http://a.com/5", f"<article><p>{menu}</p></article>"),
        (6, None, f"<p>{menu}"), (7, None, f"<p>{legal}"), (7, None, f"<p>{legal}"), (8, "nohost", None), (9, "http://a.com/9", f"<p>{menu} {menu} end"),
        (None, "http://c.com", "<p>short"),
    ]
    for length in (3, 10):
        frame = main_text(spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, loose string"), length)
        got = sorted(((r.page_id, r.text) for r in frame.collect()), key=str)
        assert got == brute_runs(pages, length)
    assert main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_the_array_alone_decides(spark):
    """Pages without an article or any telling markup: menus of few words, long notices, copies and pages with an article as evidence."""
    r = random.Random(12)
    own = lambda n: " ".join(f"w{r.randrange(400)}" for _ in range(n))
    menus = {host: [own(r.randint(1, 6)) for _ in range(4)] + [own(25)] for host in ("a.com", "b.com")}
    pages = []
    for i in range(24):
        host = r.choice(list(menus))
        blocks = [*r.sample(menus[host], r.randint(0, 5)), own(r.randint(1, 40)), f"{own(5)} {menus[host][4]} {own(5)}"]
        r.shuffle(blocks)
        body = "".join(f"<div>{block}</div>" for block in blocks)
        pages.append((i, f"http://{host}/{i}", body if i % 4 else f"{body}<article><p>article {i}</p></article>"))
    pages += [(100, *pages[1][1:]), (101, *pages[1][1:])]
    for length in (3, 5, 10):
        got = sorted(((r.page_id, r.text) for r in main_text(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5), length).collect()), key=str)
        assert got == brute_runs(pages, length)
    texts = dict(got)
    assert menus["a.com"][4] not in " ".join(texts.values()) and all(texts[i] for i in texts)


def test_frames_of_other_pages_are_evidence(spark):
    """A page without any telling markup: its links stand in the menus of pages with an article. Single blocks of frames, which
    may quote an article, take nothing out of it."""
    menu, legal, lead = (" ".join(f"{name}{i}" for i in range(12)) for name in ("menu", "legal", "lead"))
    links = "".join(f"<li><a href=/{i}>{name}</a>" for i, name in enumerate(("Home", "About us", "Shop", "Blog", "Jobs")))
    frame = f"<nav><ul>{links}</ul><p>{menu}</nav><aside>{lead}</aside><div class=comments>{lead}</div>"
    marked = [(i, f"http://a.com/{i}", f"<body>{frame}<article><p>own {i}</p></article><footer>{legal}</footer>") for i in range(4)]
    plain = f"<div>{menu}</div><h1>About us</h1><p>{lead}</p><ul>{links}</ul><p>{legal}</p>"
    pages = [*marked, (8, "http://a.com/8", plain), (9, "http://b.com/9", plain), (10, "http://c.com/10", f"<nav>{menu}</nav><p>{menu}</p>")]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)).collect()}
    assert got == {**{i: f"own {i}" for i in range(4)}, 8: f"{menu}\nAbout us\n{lead}\n{legal}", 9: "\n".join([menu, "About us", lead, "Home", "About us", "Shop", "Blog", "Jobs", legal]), 10: menu}


def test_blocks_of_the_frame():
    page = "<header>Site<br>name</header><nav><ul><li>a<li><b>b</b> c</ul><div class=ad>ad</div><article>teaser</article></nav>" + ARTICLE
    assert all_blocks(page)[2] == ["Site name", "a", "b c", "Site", "Home", "About", "© me"]


def test_suffixes_are_sorted_with_their_common_prefixes(spark):
    r = random.Random(3)
    loose = [(f"p{i}", r.choice("xy"), [" ".join(r.choices("abc", k=r.randint(1, 6))) for _ in range(r.randint(1, 4))]) for i in range(40)]
    array = suffix_array(spark.createDataFrame(loose, "row string, host string, loose array<string>").repartition(6), 6).orderBy("at").collect()
    want = sorted((host, stream(blocks)[i : i + 6], row, i) for row, host, blocks in loose for i in range(len(stream(blocks)) - 1))
    assert [(s.host, s.suffix, s.row, s.place) for s in array] == want
    for last, s in zip(array, array[1:]):
        shared = next((k for k, (a, b) in enumerate(zip(last.suffix, s.suffix)) if a != b), min(len(last.suffix), len(s.suffix)))
        assert s.lcp == (shared if last.host == s.host else 0)


def test_stray_end_tags_cost_no_search():
    page = "<div>" * 20_000 + "</span></p></section>" * 20_000 + "end"
    start = time.perf_counter()
    assert blocks_of(page) == ([], ["end"]) and time.perf_counter() - start < 5


def test_a_very_long_page(spark):
    text = " ".join(f"w{i}" for i in range(200_000))
    pages = [(1, "http://a.com/1", f"<div>{text}</div>"), (2, "http://a.com/2", f"<article>{text}</article>"), (3, "http://a.com/3", f"<p>{text} more</p>")]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {1: "", 2: text, 3: "more"}


def test_unique_runs():
    assert unique_runs(["a b c", "d e", "f"], [(2, 4)]) == "a\ne\nf"
    assert unique_runs(["a b"], [(0, 4)]) == "" and unique_runs([], []) == ""


def brute_languages(model, pages):
    """The posterior of every page in plain loops."""
    n_lang, read = len(model.languages), []
    for page_id, url, page in pages:
        article, loose = blocks_of(page)
        host = (re.match(r"[a-z]+://([^/]*)", url or "") or [None, ""])[1].lower()
        found = re.search(r"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})(?![a-z])", page or "", re.I | re.S)
        said = found[1].lower() if found else "none"
        said = said if said in (*model.languages, "none") else "other"
        shares = model.posterior("\n".join(article or loose))
        read.append((page_id, host, ".".join(host.split(".")[::-1][:2]), host.split(".")[-1], said, shares))
    total = sum(r[5] for r in read)
    out = []
    for page_id, host, domain, suffix, said, shares in read:
        prior = (total + 1 / n_lang) / (total.sum() + 1)
        for level, value in ((2, domain), (1, host)):
            own = sum(r[5] for r in read if r[level] == value) - shares
            own = own.clip(min=0)
            prior = (own + lid.KAPPA * prior) / (own.sum() + lid.KAPPA)
        odds = shares * prior
        for level, value in ((4, said), (3, suffix)):
            there = [r[5] for r in read if r[level] == value]
            odds = odds * (sum(there) + lid.ADDED * len(there) / total.sum()) / (total + lid.ADDED)
        out.append((page_id, model.languages[int(odds.argmax())], odds.max() / odds.sum()))
    return out


def test_fusion_against_plain_loops(spark):
    docs = spark.createDataFrame(
        [(i, t, l) for i, (t, l) in enumerate([("the cat and the hat", "en"), ("le chat et la robe", "fr"), (None, "en"), ("x", None), ("der hund und das tier", "de")] * 3)],
        "doc_id long, text string, lang string",
    )
    pages = [
        (1, "http://w.site.fr/1", "<html lang='fr-FR'><p>le chat</p>"), (2, "http://w.site.fr/2", "<p></p>"), (3, "http://v.site.fr/", "<html lang=xx><p>the hat"),
        (4, "http://e.com/", "<html lang=\"en\"><p>the"), (5, None, None), (6, "http://e.com/b", "<p>the cat"), (6, "http://e.com/b", "<p>the cat"), (7, "http://e.com/c", "<html lang=EN>"),
        (None, "http://E.com/d", "<p>chat"),
    ]
    model = lid.train_text_model(docs)
    assert model.languages == ("de", "en", "fr")
    frame = lid.identify_languages(spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, shares string"), docs)
    got = sorted(((r.page_id, r.lang, r.confidence) for r in frame.collect()), key=str)
    want = sorted(brute_languages(model, pages), key=str)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(math.isclose(g[2], w[2], rel_tol=1e-9) for g, w in zip(got, want))
    by_page = {r.page_id: r.lang for r in frame.collect()}
    assert by_page[2] == "fr" and by_page[7] == "en"  # no text: the host and the declaration decide


def test_languages_of_no_rows(spark):
    docs = spark.createDataFrame([(1, "the cat", "en")], "doc_id long, text string, lang string")
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert lid.identify_languages(empty, docs).collect() == []
    page = spark.createDataFrame([(1, "http://a.com", "<p>x")], "page_id long, url string, html string")
    assert [(r.page_id, r.lang) for r in lid.identify_languages(page, docs.limit(0)).collect()] == [(1, None)]


def test_languages_of_the_given_pages(spark, sf_dir):
    """The text alone, and all evidence together, agree with the language that the page declares."""
    from scolaria.llm.queries import QUERIES

    rows = QUERIES["op1_language_id"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    assert sum(r.lang == r.declared for r in rows) >= 0.98 * len(rows) and sum(r.text_lang == r.declared for r in rows) >= 0.95 * len(rows)


@pytest.mark.parametrize(
    ("page", "article"),
    [
        ("<div id=content class='right-sidebar'><article><p>a</article></div>", ["a"]),
        ("<div class='no-sidebar has-comments page-with-banner'><main>a</main></div>", ["a"]),
        ("<div class=widget><div class=banner><p>b</p><article>a</article></div></div>", ["a"]),
        ("<article>a</article><div id=comments><article>c</article></div>", ["a"]),
        ("<article><h2 id=search>h</h2><h2 id=social-effects>i</h2><section id=related-work>w</section><p class=notice>p</p><div class=related>r</div></article>", ["h", "i", "w", "p"]),
        ("<article><p>if <math><mi>x</mi><mo>=</mo><mn>1</mn></math> then</article>", ["if x=1 then"]),
    ],
)
def test_names_do_not_drop_the_article(page, article):
    assert blocks_of(page)[0] == article


def test_copies_of_a_page_on_a_host_stay(spark):
    text = " ".join(f"word{i}" for i in range(20))
    pages = [(1, "http://a.com/1", f"<p>{text}</p>"), (2, "http://a.com/2", f"<div>{text}</div>"), (3, None, f"<p>{text}</p>"), (4, None, f"<p>{text}</p>")]
    got = main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.text) for r in got) == [(i, text) for i in range(1, 5)]


def test_every_language_is_sampled(spark):
    """A language of one text in many copies, and one with more texts than the sample."""
    rows = [("un seul texte", "fr")] * 500 + [(f"own text {i}", "en") for i in range(400)] + [(None, "de"), ("kein Label", None)]
    frame = spark.createDataFrame(rows, "text string, lang string")
    model, again = (lid.train_text_model(frame.repartition(n), sample=30) for n in (2, 7))
    assert model.languages == ("en", "fr") and (model.logs == again.logs).all()
    alone = lid.train_text_model(spark.createDataFrame(rows[:500], "text string, lang string"), sample=30)
    assert (model.logs[1] == alone.logs[0]).all()


def test_language_of_a_very_long_page(spark):
    docs = spark.createDataFrame([(1, "the cat and the hat", "en"), (2, "le chat et la robe", "fr")], "doc_id long, text string, lang string")
    pages = spark.createDataFrame([(1, "http://a.com/", "<p>" + "le chat et la robe " * 100_000), (2, "http://a.com/", "<div>" * 100_000 + "the cat")], "page_id long, url string, html string")
    assert {r.page_id: r.lang for r in lid.identify_languages(pages, docs).collect()} == {1: "fr", 2: "en"}
