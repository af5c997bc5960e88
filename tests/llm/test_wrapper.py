from __future__ import annotations

import random
import time

from colonnade.llm import markup, wrapper

PAGES = "page_id long, url string, html string, host string, tree string"


def page(nav, body, foot, title="t"):
    return f"<html><head><title>{title}</title><script>var a='</p>';</script></head><body><div class=top>{nav}</div><div id=c>{body}</div><div class=bottom>{foot}</div></body></html>"


def words(rng, n):
    return " ".join(rng.choice("lorem ipsum dolor sit amet consetetur sadipscing elitr sed diam".split()) + str(rng.randrange(99)) for _ in range(n))


def texts(spark, rows):
    frame = spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], PAGES)
    return {r["page_id"]: r for r in wrapper.main_texts(frame).collect()}


def test_constant_slots_are_template(spark):
    rng = random.Random(1)
    rows, expected = [], {}
    for i in range(8):
        paragraphs = [words(rng, 12) for _ in range(rng.randint(1, 5))]
        head = words(rng, 3)
        body = f"<h1>{head}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs)
        rows.append((i, f"http://a.example/{i}", page("<ul><li>Home</li><li>About</li></ul>", body, "<p>All rights</p>", head)))
        expected[i] = "\n\n".join([head, *paragraphs])
    got = texts(spark, rows)
    assert {i: r["text"] for i, r in got.items()} == expected
    assert all(r["n_template"] == 3 and r["n_chars"] == len(r["text"]) for r in got.values())


def test_copies_do_not_make_a_template(spark):
    html = page("", "<article><h1>One title</h1><p>Same text.</p><p>Same too.</p></article>", "", "One title")
    near = html.replace("Same too", "Not quite")
    got = texts(spark, [(i, "http://b.example/x", html if i % 2 else near) for i in range(9)])
    assert got[1]["text"] == "One title\n\nSame text.\n\nSame too." and got[2]["text"] == "One title\n\nSame text.\n\nNot quite."


def test_what_is_no_main_text(spark):
    html = """<!DOCTYPE html><body><header>Site</header><nav><a href=/>Home</a></nav><div class="cookie-notice">We use</div><main>
    <article><header><h1>Title &amp; more</h1></header><p>One &lt;two&gt;<br>three&nbsp; four</p><div class=ad>Buy</div><form><input name=q>Find</form>
    <p><b>Open<p>Next <i>inline</i> text<style>p{}</style><aside>Aside</aside><blockquote>Quote</blockquote>
    <section id="comments"><p>First!</p></section></article></main><div role=complementary>Side</div><footer>Foot</footer>"""
    got = texts(spark, [(1, "https://c.example/", html), (2, None, None), (3, "http://[broken", ""), (4, "x", "<p>cut off &am"), (5, "x", "plain < text > here")])
    assert got[1]["text"] == "Title & more\n\nOne <two> three four\n\nOpen\n\nNext inline text\n\nQuote"
    assert got[2]["text"] == got[3]["text"] == "" and got[4]["text"] == "cut off &am" and got[5]["text"] == "plain < text > here"


def tree(name, *children):
    return [name, wrapper.PLAIN, [(c, len(c), 0) if isinstance(c, str) else c for c in children]]


def test_simple_tree_matching():
    a = tree("body", tree("div", tree("p", "x")), tree("ul", tree("li", "y"), tree("li", "z")), tree("p", "q"))
    b = wrapper.reference_of(tree("body", tree("ul", tree("li", "r")), tree("div", tree("p", "s")), tree("p", "t")))
    assert wrapper.match(a, wrapper.reference_of(a))[0] == 1 + 3 + 3 + 2
    assert wrapper.match(a, b) == (1 + 3 + 2, [(1, 0), (2, 2)]) or wrapper.match(a, b) == (1 + 3 + 2, [(0, 1), (2, 2)])
    assert [slot for slot, _ in wrapper.aligned(a, wrapper.reference_of(a))] == ["/0/0/0", "/1/0/0", "/1/0/0", "/2/0"]


def most_matched(x, place):
    """Simple tree matching by trying every ordered pairing of runs and kinds."""
    a = wrapper.runs(x[2])

    def best(i, j):
        if i == len(a) or j == len(place.kinds):
            return 0
        out = max(best(i + 1, j), best(i, j + 1))
        if a[i][0] == place.kinds[j]:
            out = max(out, best(i + 1, j + 1) + (1 if place.places[j] is None else most_matched(a[i][1][0], place.places[j])))
        return out

    return 1 + best(0, 0)


def test_matching_equals_brute_force():
    rng = random.Random(7)

    def grown(depth):
        return tree(rng.choice("ab"), *(grown(depth - 1) if depth and rng.random() < 0.6 else "t" for _ in range(rng.randint(0, 5))))

    for _ in range(400):
        x, y = tree("r", grown(3), grown(2), "t", grown(3)), tree("r", grown(3), grown(3), grown(2))
        place = wrapper.reference_of(y)
        size, pairs = wrapper.match(x, place)
        assert size == most_matched(x, place)
        a = wrapper.runs(x[2])
        assert pairs == sorted(pairs) and len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs)
        assert 1 + sum(1 if place.places[j] is None else most_matched(a[i][1][0], place.places[j]) for i, j in pairs) == size


def test_every_kind_of_sibling_has_its_slot():
    node = tree("body", *(tree(f"div.c{k}", f"t{k}") for k in range(1000)))
    reference = wrapper.reference_of(node)
    assert [slot for slot, _ in wrapper.aligned(node, reference)] == [f"/{k}/0" for k in range(1000)]
    # Kinds that only a later sibling has stand where it has them.
    lists = tree("body", tree("ul", *(tree(f"li.c{k}", "x") for k in range(0, 400, 2))), tree("ul", *(tree(f"li.c{k}", "x") for k in range(0, 400, 3))), tree("ul", tree("li.c0", "y"), tree("li.c0.d", "y")))
    kinds = wrapper.reference_of(lists).places[0].kinds
    assert sorted(kinds) == sorted({f"li.c{k}" for k in range(0, 400) if k % 2 == 0 or k % 3 == 0} | {"li.c0.d"})
    for part in lists[2]:
        at = [kinds.index(x[0]) for x in part[2]]
        assert at == sorted(at)


def test_template_beyond_many_kinds_goes(spark):
    rng = random.Random(11)
    wide = "".join(f"<div class=k{k}>{{}}</div>" for k in range(200))
    pages = ["<h1>" + words(rng, 3) + "</h1>" + wide.format(*(words(rng, 6) for _ in range(200))) + "<section>all rights of this line</section>" for _ in range(8)]
    got = texts(spark, [(i, "http://a.b/", f"<title>{i}</title><body>{x}") for i, x in enumerate(pages)])
    assert all("all rights" not in r["text"] and r["text"].count("\n\n") == 200 for r in got.values())


def test_wide_nodes_are_matched_best(monkeypatch):
    rng = random.Random(12)

    def grown(depth, most):
        return tree(rng.choice("abc"), *(grown(depth - 1, 4) if depth and rng.random() < 0.8 else "t" for _ in range(rng.randint(0, most))))

    for n in range(200):
        x, y = (tree("r", *(grown(2, 3) for _ in range(rng.randint(1, 30)))) for _ in range(2))
        place = wrapper.reference_of(y)
        monkeypatch.setattr(wrapper, "WORK", 10**9)
        size = wrapper.match(x, place)[0]
        if n < 50:
            small, known = tree("r", *x[2][:6]), wrapper.reference_of(tree("r", *y[2][:6]))
            assert wrapper.match(small, known)[0] == most_matched(small, known)
        monkeypatch.setattr(wrapper, "WORK", 0)
        got, pairs = wrapper.match(x, place)
        a = wrapper.runs(x[2])
        assert got == size and pairs == sorted(pairs) and all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:], strict=False))
        assert 1 + sum(1 if place.places[j] is None else wrapper.match(a[i][1][0], place.places[j])[0] for i, j in pairs) == size


def test_strange_pages_take_no_time():
    rng = random.Random(1)
    mixed = "".join(rng.choice(["<p>x", "<ul><li>y</ul>", "<div>", "</div>", "<div class=a>", "<section>", "</section>"]) for _ in range(30000))
    pages = ["<font>" * 50000, "<span>" * 50000 + "</b>" * 50000, "<p>x</p><ul><li>y</ul>" * 20000, "<div>" * 50000 + "x", "<tr><td>a<td>b" * 20000, mixed]
    for html in pages:
        began = time.process_time()
        node, _ = wrapper.block_tree(html)
        reference = wrapper.reference_of(wrapper.deep(wrapper.unpack(wrapper.pack(wrapper.skeleton(wrapper.flat(node))))))
        wrapper.main_text(node, wrapper.Wrapper(reference, frozenset(["none"])))
        assert time.process_time() - began < 8


def test_deep_and_endless_markup():
    node, _ = wrapper.block_tree("<div>" * 3000 + "deep" + "<p " * 200)
    assert "deep" in wrapper.main_text(node, wrapper.Wrapper())[0]
    assert markup.plain_text("<script>if (a < b) {</script><p>x</p><!-- y") == "x"


def test_frame_is_told_without_any_declaration(spark):
    """Menus, a notice and a footer that differ from page to page, and a host that marks nothing: matching alone tells the article."""
    rng = random.Random(9)
    rows, expected = [], {}
    for i in range(12):
        menu = "".join(f"<li><a href=/{k}>{words(rng, 1)}</a></li>" for k in range(5))
        parts = [words(rng, 4), *(words(rng, 20) for _ in range(rng.randint(2, 6)))]
        body = f"<h1>{parts[0]}</h1>" + "".join(f"<p>{p}</p>" for p in parts[1:])
        rows.append((i, "http://p.example/", f"<title>{parts[0]}</title><div class=x1><ul>{menu}</ul></div><div class=x2>{words(rng, 5)}</div><div class=x3>{body}</div><div class=x4>{words(rng, 6)}</div>"))
        expected[i] = "\n\n".join(parts)
    for declared in (True, False):
        frame = spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], PAGES)
        got = wrapper.main_texts(frame, declared).collect()
        assert {r["page_id"]: r["text"] for r in got} == expected
        assert all(r["n_template"] == 7 for r in got)


def test_the_content_slot_outweighs_its_class(spark):
    rng = random.Random(3)
    rows, expected = [], {}
    for i in range(5):
        parts = [words(rng, 4), *(words(rng, 15) for _ in range(2 + i % 3))]
        body = f"<h1>{parts[0]}</h1>" + "".join(f"<p>{p}</p>" for p in parts[1:])
        rows.append((i, "http://q.example/", f"<title>{parts[0]}</title><nav>N</nav><div class='post share'>{body}<div class=comments><p>{words(rng, 3)}</p></div></div><p>{words(rng, 2)}</p>"))
        expected[i] = "\n\n".join(parts)
    assert {i: r["text"] for i, r in texts(spark, rows).items()} == expected


def test_two_versions_of_an_article_keep_what_they_share(spark):
    shared = "".join(f"<p>Paragraph {i} of both versions.</p>" for i in range(4))
    rows = [(i, "http://r.example/", f"<title>T{i}</title><nav>N</nav><article><h1>T{i}</h1>{shared}</article>") for i in range(2)]
    got = texts(spark, rows)
    assert all(got[i]["text"].count("both versions") == 4 for i in range(2))


def test_varying_texts_stay_and_constant_ones_go(spark):
    rng = random.Random(5)
    rows, expected = [], {}
    for i in range(6):
        body = [words(rng, 9) for _ in range(1 + 4 * (i % 2))]
        rows.append((i, "http://f.example/", f"<article><h1>T{i}</h1><p>By Staff</p>" + "".join(f"<p>{p}</p>" for p in body) + "<p>Share this</p></article>"))
        expected[i] = "\n\n".join([f"T{i}", *body])
        own = words(rng, 9)
        rows.append((10 + i, "http://g.example/", f"<title>D{i}</title><div>Home</div><div>{own}</div><div>Imprint</div>"))
        expected[10 + i] = own
        rows.append((20 + i, "http://h.example/", f"<title>E{i}</title><div><ul><li>Home</ul></div><div><h1>E{i}</h1><p>{own}</p></div><div><p>Imprint</p></div>"))
        expected[20 + i] = f"E{i}\n\n{own}"
    assert {i: r["text"] for i, r in texts(spark, rows).items()} == expected


def test_blocks_are_told_at_any_depth(spark):
    inner = "<p>One</p><nav>Menu</nav><div hidden>No</div><div class=advert>Buy</div><p>Two</p>"
    rows = [(i, f"http://d{i}.example/", tags * n + inner) for i, (tags, n) in enumerate([("<div>", 3), ("<div>", 5000), ("<font>", 300), ("<b><span>", 120)])]
    got = texts(spark, rows)
    assert [got[i]["text"] for i in range(4)] == ["One\n\nTwo"] * 4
    rows = [(i, "http://e.example/", "<div>" * 2000 + f"<h1>T{i}</h1><p>Constant</p>") for i in range(6)]
    assert {i: r["text"] for i, r in texts(spark, rows).items()} == {i: f"T{i}" for i in range(6)}


def test_empty_table(spark):
    assert wrapper.main_texts(spark.createDataFrame([], PAGES)).count() == 0
