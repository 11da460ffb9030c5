import random
import time

from eventmart.llm import html_text as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="ad-free">
<header>Site</header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<article class="post"><h1>Caf&eacute; &amp; more</h1><p><b>First <i>one</i><br>goes
 on.<p>Second &lt;tag&gt;&nbsp;x</p><div id="comments"><p>Nice!</p></div><aside>See also</aside><form><p>Mail</p></form>
<ul><li>item one<li>item two</ul><!-- note --><p>Last</p></article><p>outside</p><footer>End</footer></body></html>"""


def plain(pages):
    """Texts of a host's pages that are given in one shard."""
    often = H.host_boilerplate([[H.stream_of(p) for p in pages]])
    return H.page_texts(pages, [often] * len(pages))


def text_of(html):
    return plain([H.blocks(html)])[0]


def pairs(html):
    return [(b.text, b.main) for b in H.blocks(html)]


def test_markup():
    assert text_of(PAGE).split("\n\n") == [
        "Café & more", "First one goes on.", "Second <tag> x", "item one", "item two", "Last",
    ]
    assert [t for t, _ in pairs("<p>a<p>b<div>c</div>d</p>e")] == ["a", "b", "c", "d", "e"]
    assert pairs("<div class=ad>x") == [] and pairs("<div class=ad>x</div>y") == [("y", False)]
    assert pairs("<article><h1 class='post-header'>x</h1></article>") == [("x", True)]
    assert pairs("no markup  at\nall") == [("no markup at all", False)]


def test_names_that_only_hold_a_marked_word_keep_the_text():
    article = "<article><p>main text</p><div class='{}'>a paragraph</div></article>"
    wrappers = ("layout has-sidebar", "no-comments", "with-nav", "menu-open", "site-search-enabled", "sidebar", "page-header")
    for name in wrappers:
        for attr in ("class", "id"):
            page = f"<div {attr}='{name}'><nav>x</nav><p>around</p>{article.format('share-price')}<p>after</p></div>"
            assert text_of(page) == "main text\n\na paragraph", name
    for name in ("share-price", "social-science", "header-free", "adventure"):
        assert text_of(article.format(name)) == "main text\n\na paragraph", name
    for name in ("x cookie-notice", "sidebar", "ad", "ad-slot-1", "main-nav", "share-buttons", "related_posts", "site__footer"):
        assert text_of(article.format(name)) == "main text", name
        assert H.blocks(f"<div class='{name}'>x</div>") == [], name
    # What is listed stays out: by tag, other articles' teasers, readers' comments.
    for around in ("<aside>{}</aside>", "<div id=comments>{}</div>", "<div class=related>{}</div>"):
        page = article.format("x") + around.format("<article>another</article>")
        assert text_of(page) == "main text\n\na paragraph", around
    assert pairs("<div id=comments><article>a reader</article></div><p>text</p>") == [("text", False)]
    assert pairs("<main><div class=related><article>x</article></div><p>text</p></main>") == [("text", True)]


def test_page_structures():
    article = "<article><p>main text</p>{}</article>"
    # Wrappers, sections and headings named after what they hold keep it.
    assert text_of(f"<form id='aspnetForm'>{article.format('')}<input></form>") == "main text"
    for part in ("<section id='login'><p>x</p></section>", "<section id='search'><p>x</p></section>", "<p class='related'>x</p>",
                 "<h2 id='comments'>x</h2>"):
        assert text_of(article.format(part)) == "main text\n\nx", part
    # Readers' comments, adverts, forms and notices under compound names go.
    for name in ("disqus_thread", "commentlist", "reviews-and-comments", "ad-leaderboard", "newsletter-signup-cta", "sidebar-dark",
                 "cookie-bar-v2 is-open"):
        assert text_of(article.format(f"<div class='{name}'>x</div>")) == "main text", name
        assert H.blocks(f"<div id='{name.split()[0]}'>x</div>") == [], name
    assert text_of(article.format("<form><p>x</p></form>")) == "main text"
    assert text_of("<p>a</p><!-- never closed <p>b") == "a" and text_of("<p>a</p><!-- c --><p>b") == "a\n\nb"
    assert text_of("<p>one <button>Buy</button>two <span class='ad'>x</span>three</p>") == "one two three"


def test_many_open_elements_and_stray_end_tags_take_linear_time():
    began = time.monotonic()
    assert text_of("<b>" * 60_000 + "x" + "</i>" * 60_000 + "</b>" * 60_000) == "x"
    assert len(H.blocks("<div>" * 30_000 + "x" + "</p>" * 30_000)) == 1
    assert time.monotonic() - began < 20


def brute_boilerplate(streams, run):
    """Passages by counting, over distinct texts, those of each least hash once for each key."""
    distinct = {H.sketch(s): s for s in streams}
    weight = dict.fromkeys(distinct, 0)
    for t in range(2, 2 + H.KEYS):
        for value in {key[t] for key in distinct}:
            weight[min(key for key in distinct if key[t] == value)] += 1
    sums = {}
    for key, s in distinct.items():
        for passage in {tuple(s[i : i + run]) for i in range(len(s) - run + 1)}:
            sums[passage] = sums.get(passage, 0) + weight[key]
    total = sum(weight.values())
    return {p for p, w in sums.items() if w >= H.MIN_TEXTS * H.KEYS and w * H.SHARE[1] >= total * H.SHARE[0]}


def test_boilerplate_equals_brute_force():
    """However the pages are cut into shards, and with passages only in some of these."""
    random.seed(6)
    words = [f"w{k}" for k in range(40)]
    for run in (1, 2, 4, 8):
        for trial in range(12):
            shared = [random.choices(words, k=10) for _ in range(3)]
            streams = [random.choices(words, k=random.randint(0, 30)) for _ in range(14)]
            streams = [s[:5] + random.choice(shared) + s[5:] if random.random() < 0.6 else s for s in streams] + [streams[0], []]
            cut = random.randint(1, 6)
            shards = [streams[k::cut] for k in range(cut)]
            expected = brute_boilerplate(streams, run)
            hashes, whole = H._passages([list(p) for p in expected], run)
            of_expected = {int(h) for h in hashes[whole]}
            assert set(H.host_boilerplate(shards, run).tolist()) == of_expected, (run, trial)


def test_a_part_of_an_article_that_markup_is_unsure_of():
    """Under a name that half marks it, a block stays unless the host repeats it."""
    random.seed(9)
    words = [f"w{k}" for k in range(500)]
    same = " ".join(random.choices(words, k=12))
    pages = []
    for k in range(12):
        own = " ".join(random.choices(words, k=30))
        other = " ".join(random.choices(words, k=12))
        pages.append(f"<article><p>{own}</p><p>{same}</p><div class='related-xyz'>{same if k % 2 else other}</div></article>")
    found = plain([H.blocks(p) for p in pages])
    for k, text in enumerate(found):
        assert text.count("\n\n") == (1 if k % 2 else 2) and text.split("\n\n")[1] == same


def test_boilerplate_without_marks_goes(spark):
    random.seed(7)
    same = "Welcome to our wonderful shop of many many nice things"
    own = [" ".join(random.choices([f"w{k}" for k in range(500)], k=30)) for _ in range(40)]
    pages = [(k, f"http://Host/{k}", f"<div>{same}</div><p>{t}</p>", 1) for k, t in enumerate(own)]
    pages += [(100, "http://host/x", f"<article><p>{same}</p></article>", 1), (101, "http://lone/x", f"<div>{same}</div>", 1)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, text int")
    found = {r.page_id: r for r in H.main_text(frame).collect()}
    assert [found[k].text for k in range(40)] == own
    assert found[100].text == same
    assert found[101].text == same
    sharded = {r.page_id: r.text for r in H.main_text(frame, shard_tokens=300).collect()}
    assert sharded == {k: r.text for k, r in found.items()}


def test_near_copies_and_quotes_keep_their_text():
    random.seed(8)
    words = [f"w{k}" for k in range(500)]
    article = [random.choices(words, k=40) for _ in range(3)]
    copies = []
    for k in range(5):  # each with another date and one changed word
        changed = [list(block) for block in article]
        changed[k % 3][7 * k % 40] = "changed"
        copies.append([H.Block(t, False, False) for t in (f"printed on day {k}", *(" ".join(block) for block in changed))])
    quote = " ".join(article[0][20:28])
    quoting = [H.Block(" ".join([*random.choices(words, k=9), quote, *random.choices(words, k=9)]), False, False)]
    assert plain([*copies, quoting]) == ["\n\n".join(b.text for b in p) for p in [*copies, quoting]]
    # Whole blocks that a share of otherwise distinct pages has go, from near copies too.
    shared = " ".join(random.choices(words, k=12))
    others = [[H.Block(" ".join(random.choices(words, k=40)), False, False)] for _ in range(12)]
    pages = [[H.Block(shared, False, False), *p] for p in (*copies, quoting, *others)]
    assert plain(pages) == ["\n\n".join(b.text for b in p[1:]) for p in pages]


def test_shards_of_a_host_are_counted_together(spark):
    random.seed(10)
    words = [f"w{k}" for k in range(500)]
    twice, often = (" ".join(random.choices(words, k=n)) for n in (12, 9))
    rows = []
    for k in range(60):
        own = " ".join(random.choices(words, k=30))
        body = [own, *([twice] if k in (3, 41) else []), *([often] if k % 3 == 0 else [])]
        rows.append((k, f"http://h/{k}", "".join(f"<p>{t}</p>" for t in body)))
    rows += [(100 + k, f"http://h/copy{k}", rows[3][2]) for k in range(30)] + [(200, "http://h/none", None), (200, "http://h/none", None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")

    def found(**sizes):
        return sorted(tuple(r) for r in H.main_text(frame, **sizes).collect())

    whole = found()
    assert len(whole) == len(rows)
    assert {i for i, _, text, _ in whole if twice in text} == {3, 41, *range(100, 130)}
    assert not any(often in text for _, _, text, _ in whole)
    for shard_tokens in (10, 300):
        assert found(shard_tokens=shard_tokens) == whole


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", ""), (None, "http://h/", "<p>a</p>"), (3, "http://h/", "<p>a</p>"), (3, "http://h/", "<p>a</p>"), (4, "x", "<p>b</p>" * 20_000), (5, "u", "\x00<")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = sorted((repr((r.page_id, r.n_chars)) for r in H.main_text(frame).collect()))
    assert found == sorted(map(repr, [(1, 0), (2, 0), (None, 1), (3, 1), (3, 1), (4, 20_000 * 3 - 2), (5, 2)]))
    assert H.main_text(frame.limit(0)).count() == 0
