import numpy as np
import pytest
from pyspark.sql import functions as F

from crowdpulse.llm.html_text import (
    blocks, main_text, repeats, suffix_array, suffix_keys, token_stream, without_notices, without_repeats,
)

SCHEMA = "page_id long, url string, html string"


def text(html):
    return " ".join(blocks(html)[1])


@pytest.mark.parametrize("html,expected", [
    ("<article><h1>T &amp; U</h1><p>One&nbsp; two <b>th</b>ree<br>four</p></article>", "T & U One two three four"),
    ("<body><header>Site</header><nav>Menu</nav><main><p>Text.</p></main><aside>Side</aside><footer>End</footer></body>", "Text."),
    ("<article><p>Text</p><section class='comments'><article>Reader</article></section><p>more</p></article>", "Text more"),
    ("<div id=sidebar>x</div><div class='cookie-notice'>y</div><div class='ad'>z</div><article>Text</article><div class=adBox>q</div>", "Text"),
    ("<article><header><h2>Title</h2><p>By me</p></header>Text<footer>f</footer></article>", "Title Text"),
    ("<article>Text<form><label>Mail</label><button>Go</button></form><script>var a='</p>';</script><style>p{}</style> end</article>", "Text end"),
    ("<form id=aspnet><article>Text</article><input></form>", "Text"),
    ("<body class='has-sidebar no-comments'><div class='post-content'>Text</div><div>Other</div></body>", "Text"),
    ("<article>1 &lt; 2 < 3 &eacute;&#233;&#xe9; &unknown; <!-- no --> x<!DOCTYPE y>z</article>", "1 < 2 < 3 ééé &unknown; xz"),
    ("<article><p>unclosed <b>bold<p>next<div hidden>h</div><span style='display: none'>n</span> last", "unclosed bold next last"),
    ("<article a='>' b=\">\">Text</article x>tail", "Text"),
    ("<ul><li>item one</ul>plain", "item one plain"),
    ("<main role=main>a<div role='complementary'>b</div><div aria-hidden=true>c</div></main>", "a"),
    ("", ""), ("no markup  at\nall", "no markup at all"), ("<script>never closed", ""), ("<!-- open", ""), ("a <", "a <"),
    ("<main><p>Text</p><div id=disqus_thread>d</div><div class='userComments'>c</div><ul class=share-buttons><li>s</ul></main>", "Text"),
    ("<div class='site-header'>h</div><div id=topbar>t</div><p>Text</p><div class='page-footer'>f</div><div class='ad-slot'>a</div>", "Text"),
    ("<div class='content-with-sidebar'><p>Text</p><div class='comment-body'>c</div></div>", "Text"),
    ("<article class='post has-comments'><figure><figcaption>Caption</figcaption></figure><table><tr><td>a<td>b</table></article>", "Caption a b"),
    ("<textarea><article>t</article></textarea><p>x</p>", "x"),
])
def test_markup(html, expected):
    assert text(html) == expected


def test_links():
    named, found, share = blocks("<div><a href=x>Home</a> <a href=y>News</a></div><p>See <a>this</a> long text here</p>")
    assert not named and share[0] > 0.8 > 0.3 > share[1]


def test_suffix_keys_agree_where_the_tokens_do():
    rng = np.random.default_rng(1)
    tokens = rng.integers(0, 3, 3000).astype(np.uint64)
    keys = suffix_keys(tokens, 8)
    windows = [tuple(tokens[i : i + 8]) for i in range(len(tokens) - 7)]
    assert len(keys) == len(windows)
    seen = {}
    for k, w in zip(keys.tolist(), windows):
        assert seen.setdefault(k, w) == w
    assert len(seen) == len(set(windows))
    assert len(suffix_keys(tokens[:7], 8)) == 0


def test_unique_runs_stay():
    shared = [f"s{i}" for i in range(12)]
    unique = [f"u{i}" for i in range(9)]
    page = [" ".join(shared[:6] + unique[:2]), " ".join(shared + unique), "own text of the page"]
    assert without_repeats(page, np.array([], np.int64)) == page
    stream = token_stream(page)
    repeated = np.array([8 + i for i in range(5)])  # the shared words of the second block
    assert len(stream) == 8 + 21 + 5
    assert without_repeats(page, repeated) == [page[0], " ".join(unique), page[2]]
    assert without_repeats([" ".join(shared)], np.arange(5)) == [" ".join(shared)]  # never everything


def site(host, n, menu):
    body = lambda i: " ".join(f"word{(i * 31 + k * k) % 997}x{k}" for k in range(60))
    return [(f"https://{host}/p{i}", f"<div>{menu}</div><div>{body(i)}</div>", body(i)) for i in range(n)]


def test_hosts_decide_unmarked_pages(crowd):
    menu = "Welcome to our pages about everything and nothing at all since long"
    pages = site("a.example", 12, menu) + site("b.example", 1, menu)
    rows = [(i, u, h) for i, (u, h, _) in enumerate(pages)]
    rows += [(100, "https://A.example:8080/copy", pages[0][1]), (101, None, None), (102, "https://a.example/x", ""), (None, "https://a.example/y", pages[1][1]), (3, rows[3][1], rows[3][2])]
    out = {(r["page_id"], r["url"]): r for r in main_text(crowd(rows, SCHEMA)).collect()}
    for i, (u, _, own) in enumerate(pages[:12]):
        assert out[(i, u)]["text"] == own and out[(i, u)]["n_chars"] == len(own)
    assert out[(100, "https://A.example:8080/copy")]["text"] == pages[0][2]
    assert out[(12, pages[12][0])]["text"].startswith("Welcome")  # the only page of its host
    assert out[(101, None)]["text"] == "" == out[(102, "https://a.example/x")]["text"]
    assert main_text(crowd(rows, SCHEMA)).count() == len(rows)


def test_copies_are_no_boilerplate_of_each_other(crowd):
    html = "<p>" + " ".join(f"w{i}" for i in range(40)) + "</p>"
    out = main_text(crowd([(i, f"https://a.example/{i}", html) for i in range(5)], SCHEMA)).collect()
    assert {r["n_chars"] for r in out} == {len(html) - 7}


def test_passages_that_articles_share_stay(crowd):
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = [(i, f"https://a.example/{i}", f"<nav>n{i}</nav><article><p>own {i}</p><p>{passage}</p></article>") for i in range(6)]
    assert {r["text"] for r in main_text(crowd(rows, SCHEMA)).collect()} == {f"own {i} {passage}" for i in range(6)}


def test_passages_that_a_few_unmarked_pages_share_stay(crowd):
    """Every page of the host has the menu, three of twenty share a passage of their articles."""
    menu = "Welcome to our pages about everything and nothing at all since long"
    passage = " ".join(f"shared{i}" for i in range(60))
    rows, expected = [], {}
    for i, (url, html, own) in enumerate(site("a.example", 20, menu)):
        rows.append((i, url, html + (f"<div>{passage}</div>" if i < 3 else "")))
        expected[i] = own + (" " + passage if i < 3 else "")
    assert {r["page_id"]: r["text"] for r in main_text(crowd(rows, SCHEMA)).collect()} == expected
    # Asked for any repetition, the passage goes as well.
    out = {r["page_id"]: r["text"] for r in main_text(crowd(rows, SCHEMA), min_share=0.0).collect()}
    assert out[0] == expected[0].removesuffix(" " + passage) and out[5] == expected[5]
    with pytest.raises(ValueError):
        main_text(crowd(rows, SCHEMA), min_pages=1)


def test_long_page_and_empty_table(crowd):
    out = main_text(crowd([(1, "https://a.example/", "<article>" + "<p>word" * 200_000)], SCHEMA)).first()
    assert out["n_chars"] == 5 * 200_000 - 1
    assert main_text(crowd([], SCHEMA)).collect() == []


def test_many_end_tags_without_a_start_take_linear_time():
    import time

    from crowdpulse.llm.html_text import blocks

    took = []
    for n in (20_000, 80_000):
        page = "<article>" + "<div>" * n + "</p>" * n + "words at the end</article>"
        start = time.process_time()
        assert blocks(page)[1] == ["words at the end"]
        took.append(time.process_time() - start)
    assert took[1] < 10 * took[0] + 0.5


def test_bytes_that_are_no_text(spark):
    df = spark.range(1).select(F.col("id").alias("page_id"), F.lit("http://a/").alias("url"), F.expr("cast(concat(cast('<article>x' as binary), x'ff', cast('</article>' as binary)) as string)").alias("html"))
    assert [r["text"] for r in main_text(df).collect()] == ["x\ufffd"]


def test_suffixes_are_in_order_with_common_prefixes():
    rng = np.random.default_rng(2)
    for kinds, n in ((1, 40), (2, 300), (3, 300), (60, 400), (4, 1), (9, 2)):
        once = rng.integers(0, kinds, n)
        for tokens in (once, np.concatenate([once, once, [kinds], once])):
            order, common = suffix_array(tokens)
            suffixes = sorted((tokens[i:].tolist(), i) for i in range(len(tokens)))
            assert order.tolist() == [i for _, i in suffixes]
            for (a, _), (b, _), c in zip(suffixes, suffixes[1:], common[1:]):
                assert a[:c] == b[:c] and a[c : c + 1] != b[c : c + 1]
            assert common[0] == 0


def windows(page, run=8):
    words = " ".join(page).split()
    return [tuple(words[i : i + run]) for i in range(len(words) - run + 1)]


def test_repeated_substrings_equal_brute_force():
    rng = np.random.default_rng(3)
    pages = [[" ".join(f"w{x}" for x in rng.integers(0, 2, rng.integers(1, 30))) for _ in range(rng.integers(1, 4))] for _ in range(30)]
    groups = np.repeat(np.arange(3), 10)
    least = np.array([2, 1, 3.5])
    expected = []
    for i, page in enumerate(pages):
        own = [set(windows(pages[j])) for j in range(30) if groups[j] == groups[i]]
        expected += [(i, at) for at, w in enumerate(windows(page)) if sum(w in o for o in own) >= least[groups[i]]]
    page, place, key = repeats(pages, groups, least)
    assert list(zip(page.tolist(), place.tolist())) == expected and 100 < len(expected) < sum(len(windows(p)) for p in pages)
    # Equal substrings have equal keys, also in another array.
    texts = {}
    for p, at, k in zip(page.tolist(), place.tolist(), key.tolist()):
        assert texts.setdefault(k, windows(pages[p])[at]) == windows(pages[p])[at]
    assert len(set(texts.values())) == len(texts)
    assert suffix_keys(token_stream(pages[page[0]])).view(np.int64)[place[0]] == key[0]


def test_articles_go_through_the_suffix_array(crowd):
    """A notice that no markup tells goes from every article of a host, passages of some articles stay."""
    notice = "This offer ends soon so write to our desk today and tell your friends"
    passage = " ".join(f"shared{i}" for i in range(60))
    rows, expected = [], {}
    for host, n in (("a.example", 24), ("b.example", 19)):
        for i, (url, _, own) in enumerate(site(host, n, "")):
            quoted = [passage] if i < 8 else []
            rows.append((len(rows), url, "<article>" + "".join(f"<p>{b}</p>" for b in [own, notice, *quoted]) + "</article>"))
            expected[len(rows) - 1] = " ".join([own, *([notice] if n < 20 else []), *quoted])
    assert {r["page_id"]: r["text"] for r in main_text(crowd(rows, SCHEMA)).collect()} == expected
    out = {r["page_id"]: r["text"] for r in main_text(crowd(rows, SCHEMA), article_pages=25).collect()}
    assert all(notice in t for t in out.values())


def test_articles_that_are_near_copies_stay(crowd):
    body = " ".join(f"same{i}" for i in range(60))
    rows = [(i, f"https://a.example/{i}", f"<article><p>On day {i}</p><p>{body}</p></article>") for i in range(30)]
    assert {r["text"] for r in main_text(crowd(rows, SCHEMA)).collect()} == {f"On day {i} {body}" for i in range(30)}
    assert without_notices(["a " * 8, "b"], np.array([0])) == ["a " * 8, "b"]
    assert without_notices(["x " * 9 + "x", "a " * 7 + "a"], np.array([10])) == ["x " * 9 + "x"]
    assert without_notices(["x " * 9 + "x", "a " * 8 + "a"], np.array([10])) == ["x " * 9 + "x", "a " * 8 + "a"]  # not whole


@pytest.mark.parametrize("share", [0.3, 0.0])
def test_parts_of_a_large_host_find_what_the_host_repeats(crowd, share):
    rng = np.random.default_rng(4)
    some = [" ".join(f"s{k}x{i}" for i in range(12)) for k in range(6)]
    rows, pages = [], {}
    for i in range(60):
        page = [" ".join(f"own{i}x{k}" for k in range(20))] + [b for k, b in enumerate(some) if rng.random() < (0.1, 0.2, 0.28, 0.32, 0.4, 0.9)[k]]
        for copy in range(1 + 3 * (i % 7 == 0)):
            rows.append((100 * copy + i, f"https://a.example/{i}", "".join(f"<p>{b}</p>" for b in page)))
            pages[100 * copy + i] = page
    distinct = list({tuple(p) for p in pages.values()})
    held = {}
    for p in distinct:
        for w in set(windows(p)):
            held[w] = held.get(w, 0) + 1
    expected = {}
    for i, p in pages.items():
        at = [k for k, w in enumerate(windows(p)) if held[w] >= 2 and held[w] >= share * len(distinct)]
        expected[i] = " ".join(without_repeats(p, np.array(at, np.int64)))
    for group in (300, 1 << 18):
        out = {r["page_id"]: r["text"] for r in main_text(crowd(rows, SCHEMA), min_share=share, group=group, group_pages=6).collect()}
        assert out == expected
    assert any(b in expected[i] for i in pages for b in some) == (share > 0)
