"""Pages that are copies, or whose elements have names like those of menus."""

import random
from collections import Counter, defaultdict

from kinmatch.llm import html_main


def texts(spark, rows):
    df = spark.createDataFrame([(k, "http://h/x", h) for k, h in enumerate(rows)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in html_main.extract(df).collect()}


def story(k, words=None):
    return f"<body><div id=top>Our great site</div><div id=story><p>{words or f'story {k} words'}</p></div><div id=end>All rights</div></body>"


def test_copies_keep_their_text(spark):
    got = texts(spark, [story(0)] * 6 + [story(k) for k in range(1, 5)])
    assert {got[k] for k in range(6)} == {"story 0 words"}
    assert [got[k] for k in range(6, 10)] == [f"story {k} words" for k in range(1, 5)]
    # copies alone are one page, so nothing tells the template
    assert set(texts(spark, [story(0)] * 3).values()) == {"Our great site\nstory 0 words\nAll rights"}


def test_a_template_leaves_some_text(spark):
    # the same words on pages of different markup
    got = texts(spark, [story(k, "same words").replace("<body>", f"<body><!-- {k} -->") for k in range(4)])
    assert all("same words" in t for t in got.values())


def test_names_around_the_body(spark):
    wrapped = lambda k, c: f"<body><p>menu</p><div class='{c}'><article><div class='entry-header'><h1>Title {k}</h1></div><p>story {k} of many words</p><div class='ad'>buy</div><section class='related-work'>others {k}</section></article></div></body>"
    for c in ("content-sidebar-wrap", "has-sidebar", "sidebar"):
        got = texts(spark, [wrapped(k, c) for k in range(4)])
        assert got == {k: f"Title {k}\nstory {k} of many words\nothers {k}" for k in range(4)}
    # an article in a sidebar is not the body where the varying text is beside it
    promo = [f"<body><div class='sidebar'><article>buy {k}</article></div><div><p>a long story with the number {k}</p></div></body>" for k in range(4)]
    assert texts(spark, promo) == {k: f"a long story with the number {k}" for k in range(4)}


def test_names_that_still_drop():
    assert html_main.main_text("<div class='cookie-banner'>c</div><ul class='breadcrumb nav'>b</ul><div id='comments'>r</div><p>text</p>") == "text"
    assert html_main.main_text("<div id='page' class='sidebar'><nav>n</nav><p>all text</p></div>") == "all text"


def plain(k, n=3):
    """A host of plain divs: menu, advert and footer vary from page to page, as the story does."""
    menu = "".join(f"<a href='/{k}/{j}'>entry {k} {j}</a> " for j in range(6))
    story_ = "".join(f"<p>paragraph {j} of story {k} tells at some length what happened on day {k * 7 + j}</p>" for j in range(n))
    return (
        f"<html><body><div class=a>{menu}</div><div class=b>buy {k} now</div><div class=c><div class=d><h2>Title {k}</h2></div><div class=e>{story_}</div></div>"
        f"<div class=f><a href='/x'>more {k}</a></div><div class=g>All rights {k} <a href='/i'>imprint</a></div></body></html>"
    )


def plain_text(k, n=3):
    return "\n".join([f"Title {k}", *[f"paragraph {j} of story {k} tells at some length what happened on day {k * 7 + j}" for j in range(n)]])


def test_hosts_of_plain_divs(spark):
    pages = [plain(k, 1 + k % 4) for k in range(12)]
    got = texts(spark, pages)
    assert got == {k: plain_text(k, 1 + k % 4) for k in range(12)}
    # without the host's template some pages give another text
    assert any(html_main.main_text(p) != got[k] for k, p in enumerate(pages))


def test_pages_apart_from_their_host(spark):
    """Pages of another layout, or cut off, on a host of plain divs keep their own text."""
    odd = ["<p>a page of its own</p>", plain(50)[:700], None, "", "<div><p>first words</p><p>other words</p></div>"]
    got = texts(spark, [plain(k) for k in range(12)] + odd)
    assert got[12] == "a page of its own" and got[14] == got[15] == "" and got[16] == "first words\nother words"
    assert "paragraph 0 of story 50" in got[13]


def test_odd_markup():
    read = html_main.main_text
    assert read("<article><p title=it's>Hello friend</p><p>don't stop</p></article>") == "Hello friend\ndon't stop"
    assert read('<p title="never closed>Hello</p><p>more</p>') == "Hello\nmore"
    assert read("<p data-x='a > b' class=\"x\">said &lt;so&gt; &#x41;</p>") == "said <so> A"
    assert read("<article><header class='entry-header'><h1>My title</h1></header><div class='alert'>Mind the gap</div><div class='header'>By me</div><p class='share-price'>The price rose</p></article>") == "My title\nMind the gap\nBy me\nThe price rose"
    long = "<article>" + "<p>some words of a long page</p>" * 20_000 + "</article>"
    assert read(long) == "\n".join(["some words of a long page"] * 20_000)
    assert read("<p " + 'a="' * 50_000) == ""


def brute_template(pages):
    """Equivalence classes by the occurrence vectors themselves, over distinct pages."""
    seen = {}
    for h in pages:
        tokens, blocks = html_main.read_page(h)
        seen.setdefault((tuple(t for t, _ in tokens), tuple((x.at, x.text) for x in blocks)), (tokens, blocks))
    vectors, places, chars = defaultdict(lambda: [0] * len(seen)), defaultdict(list), Counter()
    for k, (tokens, blocks) in enumerate(seen.values()):
        events = sorted([(x.at + n, html_main._text_token(x), len(x.text)) for n, x in enumerate(blocks) if not x.body and not x.dropped] + [(at + sum(x.at <= at for x in blocks), t, n) for at, (t, n) in enumerate(tokens)])
        first = {}
        for place, t, n in events:
            vectors[t][k] += 1
            chars[t] += n
            first.setdefault(t, place)
        for t, place in first.items():
            places[t].append(place)
    classes = defaultdict(list)
    for t, v in vectors.items():
        on = sum(map(bool, v))
        if on > 1 and on >= len(seen) / 2:
            classes[tuple(v)].append(t)
    place = {t: sum(p) / len(p) for t, p in places.items()}
    best = max((c for c in classes.items() if max(c[0]) == 1 and len(c[1]) >= 3), key=lambda c: (sum(map(bool, c[0])), len(c[1])), default=(None, None))[1]
    every = sorted(t for c in classes.values() for t in c)
    return len(seen), sorted(best or (), key=place.get), every


def test_templates_by_brute_force(spark):
    rng = random.Random(6)
    for _ in range(4):
        pages = []
        for k in range(rng.randint(3, 9)):
            parts = [f"<div id={c}>" + rng.choice(["same words", f"words {k}", ""]) + "</div>" for c in "abcde" if rng.random() < 0.8]
            pages.append("<body><div id=first>x</div>" + "".join(parts) + f"<p>story {k}</p>" * rng.randint(0, 3) + "</body>")
        pages += pages[:2]
        df = spark.createDataFrame([(k, "http://h/x", h) for k, h in enumerate(pages)], "page_id long, url string, html string")
        got = html_main.templates(df).collect()
        n, root, every = brute_template(pages)
        if got:
            assert got[0].n_pages == n and (got[0].root or []) == root
            assert sorted((got[0].root or []) + [x.token for x in got[0].nested or []]) == every
        else:
            assert not every


def test_slots_by_hand():
    frame = ["body:0", "div:1", "/div:1", "div:2", "h2:3", "/h2:3", "/div:2", "/body:0"]
    slots = {2: html_main.Slot(chars=60, linked=58), 5: html_main.Slot(chars=10, heading=10), 6: html_main.Slot(chars=300), 7: html_main.Slot(chars=20, fixed=20)}
    assert html_main.choose(frame, slots, 0.5) == (frozenset([5, 6]), False)
    assert html_main.choose(frame, {2: html_main.Slot(chars=5, linked=5)}, 0.5) is None
    assert html_main.choose([], {0: html_main.Slot(chars=5)}, 0.5) is None


def test_odd_pages(spark):
    rows = [(None, "http://h/1", story(1)), (1, None, story(2)), (1, "http://H/2", story(2)), (1, "http://h/2", story(2))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as host", "'x' as body", "'x' as marks", "'x' as _h", "'x' as text")
    got = sorted((r.page_id or -1, r.url or "", r.text) for r in html_main.extract(df).collect())
    assert [x[:2] for x in got] == [(-1, "http://h/1"), (1, ""), (1, "http://H/2"), (1, "http://h/2")] and all("story" in x[2] for x in got)
