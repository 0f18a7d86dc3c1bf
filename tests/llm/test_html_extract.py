"""HTML extraction: blocks, the host suffix array, and whole pages."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from evstar.llm.html_blocks import ARTICLE, NEUTRAL, OTHER, blocks, boxed_blocks
from evstar.llm.html_extract import covered, extract_main_text, main_texts, suffix_ranks


@pytest.mark.parametrize(
    "page,want",
    [
        ("<article><h1>T &amp; x</h1><p>a<br>b &nbsp; c<p>d</article><footer>f</footer>", ["T & x", "a b c", "d"]),
        ("<body><nav><ul><li>m</ul></nav><main><p>one\n two</p></main><aside>s</aside>", ["one two"]),
        ('<article><div class="comments"><p>nice</div><form>q</form><p title="a>b">z</article>', ["z"]),
        ("<article><script>if(a<b)'</p>'</script><style>p{}</style><!-- <p>no --><p>y</article>", ["y"]),
        ("<article><header><h1>H</h1><span>by me</span></header><p>x</article><header>site</header>", ["H", "x"]),
        ('<article><div hidden>h</div><p aria-hidden="true">i<p>x<div style="display: none">j</div></article>', ["x"]),
        ('<div class="ad">buy</div><article>plain <b>bold</i> text<ul><li>x<li>y</ul></article>', ["plain bold text", "x", "y"]),
        ("<article><table><tr><td>a<td>b<tr><th>c</table></article>", ["a b", "c"]),
        ("<article>&lt;p&gt; &#233;&#x41; &copy &unknown;</article>", ["<p> éA © &unknown;"]),
        ("<article><p>unclosed <b>x", ["unclosed x"]),
        ('<div id="cookie-notice">ok?</div><article class="post"><p>x</p></article>', ["x"]),
        ("", []),
    ],
)
def test_article_blocks(page, want):
    assert [t for z, t in blocks(page) if z == ARTICLE] == want


def test_zones():
    assert blocks("<p>n</p><nav>o</nav><article>a</article>") == [(NEUTRAL, "n"), (OTHER, "o"), (ARTICLE, "a")]


@given(st.text(alphabet="<>/\"'ab! -=&;p", max_size=60))
@settings(max_examples=300, deadline=None, derandomize=True)
def test_any_markup_is_read(page):
    assert all(t and t == " ".join(t.split()) for _, t in blocks(page))


def test_hostile_markup_takes_linear_time():
    for page in ("<p " + 'a="' * 40_000, "<" * 100_000, "<div>" * 3_000 + "x" + "</div>" * 3_000, "<!--" * 40_000, "<b a=" + "'\"" * 40_000):
        blocks(page)


@given(st.lists(st.integers(0, 2), min_size=1, max_size=40), st.integers(1, 9))
@settings(max_examples=150, deadline=None, derandomize=True)
def test_suffix_array_sorts_by_the_leading_tokens(tokens, depth):
    t = np.array(tokens)
    order, rank = suffix_ranks(t, depth)
    keys = [tuple(tokens[i : i + depth]) for i in range(len(tokens))]
    assert [keys[i] for i in order] == sorted(keys)
    assert all((rank[i] < rank[j]) == (keys[i] < keys[j]) for i in range(len(t)) for j in range(len(t)))


def plain_covered(streams, k, pages):
    seen = {}
    for p, s in enumerate(streams):
        for i in range(len(s) - k + 1):
            seen.setdefault(tuple(s[i : i + k]), set()).add(p)
    out = []
    for s in streams:
        flags = np.zeros(len(s), bool)
        for i in range(len(s) - k + 1):
            if len(seen[tuple(s[i : i + k])]) >= pages:
                flags[i : i + k] = True
        out.append(flags.tolist())
    return out


@given(st.lists(st.lists(st.sampled_from("abc"), max_size=14), max_size=6), st.integers(1, 4), st.integers(2, 3))
@settings(max_examples=200, deadline=None, derandomize=True)
def test_coverage_matches_brute_force(streams, k, pages):
    assert [c.tolist() for c in covered(streams, k, pages)] == plain_covered(streams, k, pages)


def bare(i, body):
    return f"<div>Welcome to the site of all good things</div><div>{body}</div><div>Page {i} of the old archive</div><div>all rights are kept by its one owner here</div>"


def test_pages_without_an_article_lose_what_repeats():
    pages = [blocks(bare(i, f"alpha{i} beta{i} gamma{i} delta{i} epsilon{i} zeta{i} eta{i}")) for i in range(5)]
    got = main_texts(pages)
    assert got[3] == "alpha3 beta3 gamma3 delta3 epsilon3 zeta3 eta3\n\nPage 3 of the old archive" or got[3].startswith("alpha3 beta3")
    assert all("Welcome" not in t and "rights" not in t for t in got)


def test_articles_keep_text_that_repeats():
    page = "<nav>a b</nav><article><p>the very same lead on every page of this site</p><p>own {}</p></article>"
    got = main_texts([blocks(page.format(i)) for i in range(6)])
    assert got == [f"the very same lead on every page of this site\n\nown {i}" for i in range(6)]


def test_table_and_awkward_rows(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r["page_id"]: r for r in extract_main_text(pages).collect()}
    assert len(got) == pages.count() and all(r["n_chars"] == len(r["text"]) for r in got.values())
    for r in pages.collect():  # no box of these articles repeats
        want = "\n\n".join(t for z, t in blocks(r["html"]) if z == ARTICLE)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["url"] == r["url"]
    rows = [(1, None, None), (2, "not a url", "<p>x</p>"), (None, "http://h/a", ""), (3, "http://H/a", "<article>y</article>"), (3, "http://H/a", "<article>y</article>"), (4, "http://h/b", "<article>" + "z " * 50_000)]
    odd = spark.createDataFrame([(i, u, h, "t", 1, 2) for i, u, h in rows], "page_id long, url string, html string, text string, shard int, shards int")
    out = sorted(((r["page_id"] or 0, r["text"][:3], r["n_chars"]) for r in extract_main_text(odd).collect()))
    assert out == [(0, "", 0), (1, "", 0), (2, "x", 1), (3, "y", 1), (3, "y", 1), (4, "z z", 99_999)]
    assert extract_main_text(odd.limit(0)).count() == 0


def test_a_large_host_is_dealt_over_shards(spark):
    rows = [(i, f"http://big.example/{i}", bare(i, f"own{i} words{i} only{i} on{i} this{i} page{i} here{i}")) for i in range(90)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in extract_main_text(pages, pages_per_shard=20).collect()}
    assert len(got) == 90 and all("Welcome" not in t and f"own{i} words{i}" in t for i, t in got.items())


def test_the_size_of_a_host_changes_no_text(spark):
    rare = "<div>this line stands on just a few pages of the whole host</div>"
    rows = [(i, f"http://big.example/{i}", f"<p>own{i} words{i} only{i} on{i} this{i} page{i} here{i}</p>" + (rare if i % 25 == 0 else "")) for i in range(90)]
    rows += [(100, "http://big.example/a", f"<article>x</article>{rare}"), (101, "http://big.example/t", "<p>told twice and no more than that</p>")]
    rows += [(102, "http://big.example/s", "<p>the same page many times over again here</p>")] * 40
    rows += [(200, "http://small.example/t", "<p>told twice and no more than that</p>")] * 2 + [(None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole = sorted(map(str, extract_main_text(pages).collect()))
    assert sorted(map(str, extract_main_text(pages, pages_per_shard=5).collect())) == whole and len(whole) == len(rows)
    got = {r["page_id"]: r["text"] for r in extract_main_text(pages, pages_per_shard=5).collect()}
    assert got[25] == "own25 words25 only25 on25 this25 page25 here25" and got[100] == "x" and got[102] == "" and got[200] == got[101] != ""


@pytest.mark.parametrize(
    "page,want",
    [
        ('<div class="layout has-sidebar"><article><p>x</p></article></div>', ["x"]),
        ('<div class="sidebar-layout"><main><p>x</p></main><div class="sidebar">s</div></div>', ["x"]),
        ('<div class="search-page"><article><p>x</p><div class="related">r</div></article></div>', ["x"]),
        ('<article class="post comments-open"><p>x</p></article>', ["x"]),
        ('<article class="post related-topics"><p>x</p></article>', ["x"]),
        ('<div class="widget"><div itemprop="articleBody">x</div></div>', ["x"]),
        ('<main><h1>h</h1><div class="promo-layout"><article>x</article></div></main>', ["h", "x"]),
        ('<article><p>x</p><div class="related"><article>card</article></div></article><div class="related"><article>card</article></div>', ["x"]),
        ('<aside><article>card</article></aside><article>x</article>', ["x"]),
        ("<article><p>a <svg><path></p><p>b</p></article>", ["a", "b"]),
        ("<article><div><select><option>o</div><p>b</p><select><option>q</select></article>", ["b"]),
        ("<article><div><template><p>t</p></div><p>b</p></article>", ["b"]),
        ("<article><svg><svg></svg><text>t</text></svg><p>b</p></article>", ["b"]),
        ("<article><div><object><object></object>o</object></div><p>b</p></article>", ["b"]),
        ("<article><div><textarea>t</div><p>b</p></article>", ["b"]),
        ("<article><select><option>o<script></select></script></select><p>b</p></article>", ["b"]),
    ],
)
def test_no_whole_article_is_lost(page, want):
    assert [t for z, t in blocks(page) if z == ARTICLE] == want


def test_text_outside_of_articles_survives_states_and_raw_elements():
    assert blocks('<div id="page" class="no-sidebar"><p>x</p></div>') == [(NEUTRAL, "x")]
    assert blocks("<body><select><option>o<p>x</p></body>") == [(NEUTRAL, "x")]


def test_raw_elements_take_linear_time():
    for piece in ("<svg><p>", "<select>", "<textarea>", "<object><div>", "<template></b>"):
        blocks(piece * 3_000 + "</svg>")


def story(i, extra="", after=""):
    own = " ".join(f"own{i}story{k}" for k in range(30))
    return f"<nav>a b</nav><article><h1>Title {i}</h1><p>{own}</p>{extra}</article>{after}"


BOX = '<div class="box">Sign up here for our weekly letter and get it every Friday</div>'
COMMENT = '<section class="discussion"><article>I disagree with number {}</article></section>'


def own_text(i):
    return f"Title {i}\n\n" + " ".join(f"own{i}story{k}" for k in range(30))


@pytest.mark.parametrize("shard", [512, 2])
def test_repeats_decide_inside_articles_too(spark, shard):
    rows = [(i, f"http://h.example/{i}", story(i, BOX, COMMENT.format(i))) for i in range(6)]
    rows += [(10 + i, "http://few.example/x", story(i, BOX, COMMENT.format(i))) for i in range(2)]  # too few pages to tell
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in extract_main_text(pages, pages_per_shard=shard).collect()}
    assert all(got[i] == own_text(i) for i in range(6))
    assert all("Sign up here" in got[10 + i] and "I disagree" in got[10 + i] for i in range(2))


@pytest.mark.parametrize("shard", [512, 2])
def test_copied_and_nearly_copied_articles_stay(spark, shard):
    body = "".join(f"<div><p>paragraph {k} of an article that many pages carry word by word</p></div>" for k in range(6))
    rows = [(i, f"http://h.example/{i}", f"<article><h1>One title</h1>{body}</article>") for i in range(5)]
    rows += [(10 + i, f"http://h.example/n{i}", f"<article><h1>Title {i} of its own</h1>{body}</article>") for i in range(5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in extract_main_text(pages, pages_per_shard=shard).collect():
        assert r["text"].count("paragraph") == 6, r


def test_boxes_with_words_of_their_own_and_lists_of_articles_stay():
    box = '<div class="box">Sign up here for our weekly letter and get it every {}</div>'
    pages = [boxed_blocks(story(i, box.format(f"day{i}"))) for i in range(5)]
    assert all(f"day{i}" in t for i, t in enumerate(main_texts(pages)))
    listed = [boxed_blocks(f"<main><article><p>first {i} a b</p></article><article><p>second {i} c d</p></article></main>") for i in range(5)]
    assert main_texts(listed)[2] == "first 2 a b\n\nsecond 2 c d"
    wrapped = [boxed_blocks(f'<article><div class="entry"><p>{"own%d " % i * 20}</p>{BOX}</div></article>') for i in range(5)]
    assert all("Sign up" not in t and t.startswith(f"own{i}") for i, t in enumerate(main_texts(wrapped)))


def test_boxes_of_blocks():
    page = '<article><p>a</p><div><p>b</p><section>c</section></div><p>d</p></article><div id="x" class="talk us"><article>e</article></div><article>f</article>'
    assert [(t, b.split(" ", 1)[0], b) for _, t, b in boxed_blocks(page)][0] == ("a", "", "")
    got = {t: b for _, t, b in boxed_blocks(page)}
    assert got["b"] != got["c"] and got["b"].startswith("box ") and got["c"].startswith("box ") and got["d"] == ""
    assert got["e"] == "after div talk us x" and got["f"] == ""
