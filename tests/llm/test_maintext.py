import math
import random

import pytest

from jobweave.llm import maintext, queries

PAGE = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body class="has-menu">
<header class="page"><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav>
<div class="cookie-notice"><p>We use cookies. %s</p></div>
%s<footer>&copy; somebody</footer><form><p>Your mail</p></form><script>document.write("<p>no</p>")</script></body></html>"""


def page(body, notice="Really."):
    return PAGE % (notice, body)


def test_article_without_its_surroundings():
    body = "<article><header><h1>Title &amp; more</h1></header><p>First\n  <b>bold</b>&nbsp;text<br>goes on<p>Second<!-- c --></p><aside>ad</aside><ul><li>one<li>two</ul><section class='comments'><p>me too</p></section></article>"
    want = "Title & more\nFirst bold text goes on\nSecond\none\ntwo"
    assert maintext.main_text(page(body)) == want
    assert maintext.main_text(page(body, "very long " * 300)) == want


def test_the_densest_subtree_without_semantic_tags():
    text = "".join(f"<p>Paragraph number {i} has a number of words in it.</p>" for i in range(6))
    side = "".join(f"<li><a href='{i}'>link {i}</a></li>" for i in range(30))
    got = maintext.main_text(page(f"<div><div id='left'><ul>{side}</ul></div><div class='text'><h2>Head</h2>{text}</div></div>"))
    assert got.split("\n") == ["Head"] + [f"Paragraph number {i} has a number of words in it." for i in range(6)]


def test_text_in_several_sections_is_whole():
    parts = "".join(f"<section><h2>Part {i}</h2><p>{'words ' * (20 + i)}</p><p>{'more ' * 20}</p></section>" for i in range(4))
    got = maintext.main_text(f"<body><div>{parts}</div></body>")
    assert got.count("Part") == 4 and got.count("more") == 80


def test_empty_odd_and_long_pages():
    assert [maintext.main_text(h) for h in (None, "", " \n", "<script>x</script>", "<")] == ["", "", "", "", "<"]
    assert maintext.main_text("<p>only &lt;b&gt; text") == "only <b> text"
    assert maintext.main_text("<body>" + "<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    words = " ".join(f"w{i}" for i in range(200_000))
    assert maintext.main_text(f"<article><p>{words}</p></article>") == words


def test_random_articles_come_back(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for i in range(60):
        blocks = [" ".join(f"w{rng.randint(0, 99)}" for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(1, 8))]
        rows.append((i, f"u{i}", page("<article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>"), "extra"))
        want[i] = "\n".join(blocks)
    rows += [(None, None, None, None), (0, "u0", rows[0][2], "extra")]
    got = maintext.with_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(got) == 62 and all(r.text == want[r.page_id] for r in got if r.page_id is not None)
    assert [r.text for r in got if r.page_id is None] == [""]


def test_every_page_is_answered(spark, data):
    got = queries.QUERIES["op5_main_text"](spark, data).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        assert r.n_chars == len(r.text) and r.text and "track(" not in r.text and "<p>" not in r.text


def random_tree(rng, depth=0):
    """(tag, characters, children) without ambiguous nesting."""
    tag = rng.choice(["div", "section", "blockquote", "a"][: 3 if depth < 3 else 4])
    below = [] if depth > 4 or tag == "a" else [random_tree(rng, depth + 1) for _ in range(rng.randint(0, 4))]
    return tag, rng.randint(1, 90), below


def as_html(tree):
    tag, size, below = tree
    return f"<{tag}>{'x' * size}{''.join(map(as_html, below))}</{tag}>"


def figures(tree):
    """Characters, tags, characters in links and links within, from the definition."""
    tag, size, below = tree
    parts = [figures(b) for b in below]
    c = size + sum(p[0] for p in parts)
    t = sum(p[1] + 1 for p in parts)
    return (c, t, c, t + 1) if tag == "a" else (c, t, sum(p[2] for p in parts), sum(p[3] for p in parts))


def by_hand(tree, body):
    c, t, lc, lt = figures(tree)
    base = math.log(c / max(c - lc, 1) * lc + body[2] / max(body[0], 1) * c + math.e)
    return c / max(t, 1) * math.log(c / max(lc, 1) * max(t, 1) / max(lt, 1)) / math.log(max(base, 0)) if base > 1.000001 else None


def test_sums_and_threshold_by_hand():
    rng = random.Random(8)
    for _ in range(60):
        tree = ("body", rng.randint(1, 9), [random_tree(rng) for _ in range(rng.randint(1, 4))])
        root, nodes, pieces = maintext._tree(as_html(tree))
        body = nodes[1]
        maintext._count(nodes, pieces)
        chosen, worth, threshold = maintext._chosen(body, nodes)
        flat, above = [], {}

        def walk(at, parent):
            flat.append(at)
            above[len(flat)] = parent
            here = len(flat)
            for b in at[2]:
                walk(b, here)

        walk(tree, 0)  # in page order, as the nodes after the root
        whole = figures(tree)
        for k, at in enumerate(flat, 1):
            assert (nodes[k].chars, nodes[k].tags, nodes[k].link_chars, nodes[k].link_tags) == figures(at)
            want = by_hand(at, whole)
            assert want is None or worth[k] == pytest.approx(want)
        sums = {k: sum(worth[j] for j in above if above[j] == k) for k in above}
        best = max(sums, key=lambda k: (sums[k], worth[k], -k))
        assert chosen[0] is nodes[best]
        way = [best]
        while above[way[-1]]:
            way.append(above[way[-1]])
        assert threshold == min(worth[k] for k in way)


def test_density_decides(monkeypatch):
    text = "<article><h1>Head</h1>" + "<p>A paragraph of the article with some words.</p>" * 4 + "</article>"
    html = f"<body><div><p>A line beside it.</p></div><div class='ad'>Buy</div>{text}</body>"
    want = maintext.main_text(html)
    assert want.startswith("Head\nA paragraph") and "beside" not in want and "Buy" not in want
    monkeypatch.setattr(maintext, "density", lambda node, body: 0.0)
    assert maintext.main_text(html) != want
    monkeypatch.undo()
    monkeypatch.setattr(maintext, "NOISE_WORDS", frozenset())
    assert maintext.main_text(html) == want


def test_main_around_an_article_and_other_stories():
    story = "<article><p>First paragraph of the story, long enough.</p><p>Ok.</p><p>Second paragraph of the story.</p></article>"
    others = "<section><h2>More</h2>" + "".join(f"<div><a href='{i}'>Other story {i}</a><p>Teaser.</p></div>" for i in range(5)) + "</section>"
    got = maintext.main_text(f"<body><main><h1>Title</h1>{story}{others}</main></body>")
    assert got.split("\n") == ["Title", "First paragraph of the story, long enough.", "Ok.", "Second paragraph of the story."]


def test_class_words_on_prose_and_on_noise():
    prose = "<div class='social-history'><p>Work, wages and housing changed within one generation.</p></div>"
    noise = "<div class='social-links box'><p>Tell all of your friends about this story.</p></div>"
    got = maintext.main_text(f"<body><article><p>The town grew quickly in those years.</p>{prose}{noise}<p>End.</p></article></body>")
    assert got.split("\n") == ["The town grew quickly in those years.", "Work, wages and housing changed within one generation.", "End."]


def test_long_noise_in_depth_is_not_the_centre():
    long = "".join(f"<p>{'many words of a notice ' * 30}</p>" for _ in range(9))
    for wrap in (f"<aside><div><div>{long}</div></div></aside>", f"<div class='cookie-notice'><div><div>{long}</div></div></div>"):
        assert maintext.main_text(f"<body>{wrap}<article><p>Short.</p><p>Text.</p></article></body>") == "Short.\nText."


def test_menus_within_an_article_go_and_short_blocks_stay():
    menu = "<ul>" + "".join(f"<li><a href='{i}'>go {i}</a></li>" for i in range(6)) + "</ul>"
    text = "<p>A paragraph with <a href='x'>one link</a> and many more words around it.</p>" * 3
    got = maintext.main_text(f"<body><article><div>{text}</div><p>So.</p>{menu}</article></body>")
    assert got.split("\n") == ["A paragraph with one link and many more words around it."] * 3 + ["So."]
