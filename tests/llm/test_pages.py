import random

import numpy as np
from pyspark.sql import functions as F

from trafficlake.llm import pages
from trafficlake.llm.frames import read


def run(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return {r.page_id: r.text for r in pages.main_text(df).collect()}


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style></head><body class="has-sidebar"><header>Top</header>
<nav><ul><li>Menu</ul></nav><div class='ad box'>Buy</div><article class="post"><header><h1>Title &amp; more</h1></header>
<script>var t="</p><article>";</script><p>One <b>bold&nbsp;<i>word</i>
 two<br>three<!-- <p>hidden --><p title="a>b">Second &#233;&#x1F600; &lt;tag&gt; &ampx<ul><li>item<li>last</ul>
<aside>side</aside><form>Name<input></form><section id="comments"><p>Reader says</p></section></article>
<div>loose</div><footer>&copy; x</footer>"""


def test_blocks():
    lines, marked = pages.blocks(PAGE.format())
    assert marked and lines == ["Title & more", "One bold word two three", "Second é😀 <tag> &x", "item", "last"]
    assert pages.blocks("<p>a < b and c<d") == (["a < b and c"], False)
    assert pages.blocks("<div>x<div class=comment>no</div>y</div>z") == (["x", "y", "z"], False)
    assert pages.blocks("<script>never ends <p>x") == ([], False)
    for text in (None, "", " ", "<", "</", "<p", "&", "</div></div>text", "<!--"):
        assert pages.blocks(text) == ((["text"], False) if text and "text" in text else (["&"], False) if text == "&" else (["<"], False) if text == "<" else ([], False))


def test_hints_on_text_elements():
    for left_out in (
        '<p class="advert">no', '<p class=notice>no <b>no</b></p>', '<ul><li>no?<li class="comment">no<li>no?</ul>', "<p id=mainNav><a>no</a></p>",
        '<table><tr><td class="sidebar">no<td>no?<tr><td>no?</table>', '<table><tr class=ad><td>no<td>no<tr><td>no?</table>',
        '<table><tbody class=ad><tr><td>no</td></tr><tbody><tr><td>no?</table>', "<dl><dt>no?<dd class=ad>no<dt>no?</dl>",
        "<pre class=cookie>no</pre>", '<span class="ad">no<span>no</span>no</span>', "<a role=banner-ad class='promo box'>no</a>",
        "<p>no?<span class=ad>no<p>no?", "<p>no?<span class=ad>no</p>no?", "<span class=ad><p>no</p>no<div>no</div>no</span>", "<div><em class=ad>no</div>",
    ):
        for page in ("<div>one</div>{}<div>two</div>", "<article><p>one</p>{}<p>two</article>"):
            lines, _ = pages.blocks(page.format(left_out))
            assert [x for x in lines if x != "no?"] == ["one", "two"] and lines.count("no?") == left_out.count("no?"), (left_out, lines)
    for kept in (
        '<h2 id="search-algorithms">kept</h2>', '<p class="social-science">kept</p>', '<section id="related-work"><p>kept</section>', "<h3 class=ad>kept</h3>",
        '<p class="ad-hoc no-ads has-sidebar comments-open">kept</p>', '<div class="menu">kept words of a <a>menu</a></div>', "<p id=shareholders>kept</p>",
    ):
        assert "kept" in " ".join(pages.blocks(f"<article><p>one</p>{kept}</article>")[0]), kept
    for menu in ('<div class="menu"><a>no</a> <a>no</a> | </div>', '<ul class="site-nav"><li><a>no</a></ul>', '<div role="search">no</div>', '<div class="comment-list">no no</div>'):
        assert pages.blocks(f"<article><p>one</p>{menu}</article>")[0] == ["one"], menu
    kept = "<p>an <a href='/x?id=search&class=ad' data-id=ad title='id=ad'>own</a> <span class=ad>no</span> word</p>"
    assert pages.blocks(kept)[0] == ["an own word"]
    assert pages.blocks('<pre><span class="token comment"># said</span> x</pre>')[0] == ["# said x"]


def test_article_in_hinted_wrapper():
    for wrapper in (
        '<div class="page with-sidebar">{}</div>', '<div class="content no-ads">{}</div>', "<div class=sidebar>{}</div>", "<form>{}</form>",
        "<div id=banner class='ad box'><div>{}</div></div>", "<section class=notice>{}</section>",
    ):
        for article in ("<article><p>text</article>", '<main class="post no-comments"><p>text</p></main>', "<article class='ad'><p>text</p></article>"):
            assert pages.blocks(wrapper.format(article) + "<p>no") == (["text"], True), (wrapper, article)
    for wrapper in ("<nav>{}</nav>", "<aside>{}</aside>", "<footer>{}</footer>", "<div class=comments>{}</div>", "<ol id='comment-list'><li>{}</ol>"):
        assert pages.blocks(wrapper.format("<article><p>no</p></article>") + "<p>text") == (["text"], False), wrapper
    assert pages.blocks("<article>a<article class=comment>no</article>b</article>") == (["a", "b"], True)


def brute(texts, marked, run, share):
    """Covered words by comparing all runs as tuples."""
    same = {tuple(t): k for k, t in enumerate(texts)}
    where = {}
    for t, k in same.items():
        for i in range(len(t) - run + 1):
            where.setdefault(t[i : i + run], set()).add(k)
    out = []
    for t in texts:
        bare = [False] * len(t)
        for i in range(len(t) - run + 1):
            if len(where[tuple(t[i : i + run])]) >= share(len(same), marked):
                bare[i : i + run] = [True] * run
        out.append(bare)
    return out


def test_suffix_array_like_brute_force():
    draw = random.Random(6)
    for trial in range(30):
        texts = [[draw.randrange(3 if trial % 2 else 2) for _ in range(draw.randrange(0, 60))] for _ in range(draw.randrange(2, 14))]
        texts += texts[:1]
        marked = trial % 3 == 0
        share = lambda n, m: (float("inf") if n < 8 else n // 2 + 1) if m else max(2, -(-n * 2 // 100))
        got = pages.boilerplate([np.array(t, np.uint64) for t in texts], [marked] * len(texts))
        assert [g.tolist() for g in got] == brute(texts, marked, pages.RUN, share)


def test_host_boilerplate(spark):
    draw = random.Random(7)
    word = lambda: "".join(draw.choice("abcdefghijkl") for _ in range(6))
    prompt = "please sign up for our weekly letter about everything today"
    own = {k: [" ".join(word() for _ in range(20)) for _ in range(3)] for k in range(40)}
    rows = [(k, f"https://a.example/{k}", f"<div>{o[0]}</div><div>{prompt}</div><p>{o[1]}</p><p>read on {prompt} {o[2]}</p>") for k, o in own.items()]
    rows += [(100 + k, f"https://b.example/{k}", f"<article><p>{own[k][0]}</p><p>{prompt}</p></article>") for k in range(20)]
    rows += [(200 + k, f"https://c{k}.example/", f"<p>{prompt}</p>") for k in range(5)]
    got = run(spark, rows)
    for k, o in own.items():
        assert got[k] == f"{o[0]}\n{o[1]}\n{o[2]}"  # the repeat takes "read on" with it
    assert all(got[100 + k] == own[k][0] for k in range(20))
    assert all(got[200 + k] == prompt for k in range(5))


def test_hot_host_in_groups(spark, monkeypatch):
    monkeypatch.setattr(pages, "PAGES", 10)
    footer = "all rights are reserved by the owner of this very site"
    rows = [(k, f"http://h.example/{k}", f"<p>own words {k} here {k * 7} and {k * 11}</p><p>{footer}</p>") for k in range(200)]
    assert run(spark, rows) == {k: f"own words {k} here {k * 7} and {k * 11}" for k in range(200)}


def test_whole_host_like_one_array(spark):
    """Repeats on few pages of a large host, and on one page more than half of the articles, as one array over all pages."""
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdefghijkl") for _ in range(5))
    passage = [" ".join(word() for _ in range(10)) for _ in range(4)]
    rows, texts = [], {}
    for k in range(900):
        marked = k >= 600 and k % 4 != 0
        host = "h" if k < 600 else "m"
        held = [passage[0]] * (k in (7, 307)) + [passage[1]] * (k < 12) + [passage[2]] * (600 <= k < 751) + [passage[3]] * (600 <= k < 750)
        lines = [" ".join(word() for _ in range(draw.randrange(3, 12))), *held, word()]
        body = "".join(f"<p>{x}</p>" for x in lines)
        copies = 1 + (k == 600)
        rows += [(k + 1000 * c, f"http://{host}.example/{k}", f"<article>{body}</article>" if marked else body) for c in range(copies)]
        texts.setdefault(host, []).append((k, lines, marked))
    got = run(spark, rows)
    for host in texts.values():
        words = [pages.byte_hashes("\n".join(x).encode()) for _, x, _ in host]
        want = pages.boilerplate(words, [m for _, _, m in host])
        for (k, lines, marked), covered in zip(host, want, strict=True):
            assert got[k] == pages.unique_runs(lines, covered)
            assert not any(p in got[k] for p in (passage[:3] if marked else passage))
    assert got[1600] == got[600] and sum(passage[3] in t for t in got.values()) == 112


def article_rows(many, few, passage, choose):
    """Articles of one host with their own words, the passage on ``many`` of them; ``choose`` says by page number which may hold it."""
    rows, k = [], 0
    while many or few:
        own, held = f"own words {k} here {k * 7} and {k * 11} of page {k * 13}", bool(many)
        k += 1
        lines = [own, passage] if held else [own]
        if held and not choose(pages._number(b"a.example\n" + pages._page_words(lines).tobytes()) / 2**64 + 0.5):
            continue
        many, few = (many - 1, few) if held else (many, few - 1)
        rows.append((k, f"http://a.example/{k}", "<article>" + "".join(f"<p>{x}</p>" for x in lines) + "</article>", own, held))
    return rows


def test_common_passage_on_no_page_of_a_sample(spark):
    """A passage on more than half of the articles goes wherever their page numbers lie, one on just half stays."""
    passage = "please sign up for our weekly letter about everything today"
    for low in (False, True):
        rows = article_rows(101, 99, passage, lambda x: (x < 0.6) if low else (x >= 0.4))  # noqa: B023
        assert run(spark, [r[:3] for r in rows]) == {k: own for k, _, _, own, _ in rows}
    rows = article_rows(100, 100, passage, lambda x: x >= 0.4)
    assert run(spark, [r[:3] for r in rows]) == {k: f"{own}\n{passage}" if held else own for k, _, _, own, held in rows}


def test_slots_leave_no_window_out(spark, monkeypatch):
    """Copies of a page, pages of very unlike length, few slots and small pieces give what one array gives."""
    draw = random.Random(9)
    word = lambda: "".join(draw.choice("abcdefghijkl") for _ in range(5))
    passage = [" ".join(word() for _ in range(10)) for _ in range(3)]
    rows, texts = [], []
    for k in range(40):
        held = [passage[0]] * (k < 21) + [passage[1]] * (k < 20) + [passage[2]] * (k % 2 or k == 30)
        lines = [" ".join(word() for _ in range(3000 if k == 5 else draw.randrange(1, 30))), *held, word()]
        texts.append(lines)
        rows += [(k + 100 * c, f"http://h.example/{k}", "<main>" + "".join(f"<p>{x}</p>" for x in lines) + "</main>") for c in range(60 if k == 39 else 1)]
    covered = pages.boilerplate([pages.byte_hashes("\n".join(x).encode()) for x in texts], [True] * len(texts))
    want = [pages.unique_runs(x, c) for x, c in zip(texts, covered, strict=True)]
    assert sum(passage[0] in t for t in want) == 0 and sum(passage[1] in t for t in want) == 20 and sum(passage[2] in t for t in want) == 0
    for slots, held in ((4, 1 << 21), (1 / 64, 1 << 21), (4, 0)):
        monkeypatch.setattr(pages, "PAGES", slots)
        monkeypatch.setattr(pages, "HELD", held, raising=False)
        assert run(spark, rows) == {k: want[k % 100] for k, _, _ in rows}


def test_edge_rows(spark):
    rows = [(None, None, None), (1, "", ""), (2, "no url", "<p>" + "word " * 200_000), (2, "no url", "<p>" + "word " * 200_000), (3, "http://x/", "plain")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("h")).withColumn("text", F.lit(0))
    out = pages.main_text(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.n_chars) for r in out.collect()) == [(0, 0), (1, 0), (2, 999_999), (2, 999_999), (3, 5)]
    assert pages.main_text(df.limit(0)).count() == 0


def test_given_pages_keep_their_article(spark):
    df = read(spark, "/root/testdata/sf0.01", "pages")
    got = {r.page_id: r.text for r in pages.main_text(df).collect()}
    for r in df.collect():
        lines, marked = pages.blocks(r.html)
        assert marked and got[r.page_id] == "\n".join(lines) and lines
        assert not any(x in got[r.page_id] for x in ("track(", "margin:0", "©"))
