import random
import time

from framewright.llm import html

from .helpers import sentence

TREE = html.train()


def text(page):
    return html.main_text(page, TREE)


def test_training_rows_are_told_apart():
    wrong = total = 0
    for p in html.LABELLED:
        found = html.blocks_of(p)
        wrong += sum((not b.outside and TREE(row)) != (b.label == "main") for b, row in zip(found, html.described(found).tolist()))
        total += len(found)
    assert wrong <= total * 0.02


def test_tree_splits_on_words_and_neighbours():
    used = {html.FEATURES[node[0]] for node in TREE.nodes if not isinstance(node, bool)}
    assert {"words", "links"} <= used and used & {"words_before", "links_before", "words_after", "links_after"}, used


def test_held_out_layouts():
    """Pages made another way than the labelled ones; word counts of kept and lost text."""
    rng = random.Random(6)
    kept = lost = added = 0
    for k in range(60):
        body = [sentence(rng, rng.randint(12, 60)) for _ in range(4)]
        noise = [sentence(rng, rng.randint(5, 30)) for _ in range(5)]
        paragraphs = "".join(f"<p>{b}</p>\n" for b in body)
        menu = "".join(f'<li><a href="/{i}">{w}</a></li>' for i, w in enumerate(noise[0].split()))
        page = [
            f'<html><head><title>{noise[1]}</title></head><body><nav><ul>{menu}</ul></nav><article>{paragraphs}</article><div class="advert-top">{noise[2]}</div><footer>{noise[3]}</footer></body></html>',
            f'<body><div id="siteHeader"><p>{noise[1]}</p></div><ul>{menu}</ul><div class="entry-content">{paragraphs}</div><section id="comments"><p>{noise[2]}</p></section><div class="cookie-banner">{noise[3]}</div>',
            f'<body><script>var a="<p>{noise[1]}</p>";</script><main>{paragraphs}</main><aside>{noise[2]}</aside><form><p>{noise[3]}</p></form></body>',
        ][k % 3]
        got, want = text(page).split(), " ".join(body).split()
        kept += sum(w in set(got) for w in want)
        lost += max(0, len(want) - len(got))
        added += max(0, len(got) - len(want))
    assert lost + added <= 0.02 * kept


def test_decoding_and_white_space():
    page = "<article><h1>A &amp; B</h1><p>x&nbsp;y\n\t z&lt;b&gt; <b>bo</b>ld &#233;&#x41; caf&eacute;</p><p>one<br>two<p>three</article>"
    assert text(page) == "A & B x y z<b> bold éA café one two three"
    assert html.main_text(None, TREE) == html.main_text("", TREE) == html.main_text("<p>", TREE) == ""
    assert text("<article><!-- <p>no</p> --><style>p{}</style><p>yes<script>no()</script></p>") == "yes"
    assert text("<article><p>unclosed < and > and <b attr='>'>bold") == "unclosed < and > and bold"


A, B = "The harbour town had waited through the whole winter for the ferry to return.", "Nobody could say who had first seen the lights, and so it was left at that for years."


def test_names_of_the_layout_around_an_article():
    for around in ('<div class="layout has-sidebar search-enabled">', '<div class="with-menu">', '<div id="page-sidebar-left">', '<form id="aspnetForm">', '<div class="search-wrap"><div class="nav-open">'):
        assert text(f"<body>{around}<article><p>{A}</p><p>{B}</p></article>") == f"{A} {B}", around
    for around in ('<div class="comments">', "<aside>", '<div class="related-posts">'):
        assert text(f"<body><article><p>{A}</p></article>{around}<article><p>{B}</p></article>") == A, around


def test_inline_elements_that_are_not_seen():
    page = '<article><p>One <span style="display:none">secret</span>two <span class="advert">Buy <b>now</b></span>three <span>four</span> <i hidden>x<i>y</i>z</i>five</p><p>six<span class="sr-only">skip</span></p></article>'
    assert text(page) == "One two three four five six"


def test_links_go_on_through_blocks():
    page = f'<body><div><p>{A}</p><p>{B}</p></div><a href="/x"><div>Ten walks along the coast you should not miss this year</div></a></body>'
    assert [b.linked / b.words for b in html.blocks_of(page)] == [0, 0, 1]
    assert text(page) == f"{A} {B}"
    # an unclosed link ends with what it stands in
    assert [b.linked for b in html.blocks_of('<div><p><a href="/x">one</p><p>two</p></div>')] == [1, 0]


def test_broken_pages_take_time_in_proportion_to_their_length():
    def took(page):
        began = time.process_time()
        html.main_text(page, TREE)
        return time.process_time() - began

    n = 60_000
    pages = ['<a "' * n, "<a x='" * n, '<a x=">" ' * n, "<title>" * n, "<noscript>x" * n, "<!-- " * n, "<![CDATA[" * n, "<div>" * n + "</p>" * n, "<div>" * n + "</div>" * n, "<p " + "a" * 8 * n + ">x", "<p " + "a " * 4 * n + ">x", "<p x=" + " " * 8 * n + ">y", "&" * 8 * n, "<p x=\"" * n + ">" * n, '<span hidden>' * n, "</a" * n, "<" * 8 * n, "a<!" * n]
    for page in pages:
        assert took(page) < 6, page[:20]
    assert text("<article><p>" + A + "</p><p x='" + B + "</p>" + f"<p>{B}</p></article>").startswith(A)


def test_table(spark):
    rows = [(1, "u", "<article><p>Of.</p></article>"), (2, None, None), (None, "v", ""), (1, "u", "<article><p>Of.</p></article>"), (3, "w", "<article><p>" + "long words here " * 30000 + "</p></article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "1 as n_chars")
    got = {(r["page_id"], r["url"], r["n_chars"]) for r in html.extract(df).collect()}
    assert got == {(1, "u", 3), (2, None, 0), (None, "v", 0), (3, "w", 479999)}
    assert html.extract(df.where("false")).count() == 0
