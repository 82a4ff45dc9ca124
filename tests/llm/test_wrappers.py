"""HTML extraction: block reading, wrapper inference and whole pages."""

import json
import random
import re

from cartograph.llm import wrappers
from tests.llm.conftest import clashing, prose


def page(title, paragraphs, extra="", comments=(), style="article"):
    body = "".join(f"<p><b>{p[:4]}</b>{p[4:]}<br>" if i % 2 else f"<p>{p}</p>" for i, p in enumerate(paragraphs))
    talk = f"<section class='comments'>{''.join(f'<p>{c}</p>' for c in comments)}</section>" if comments else ""
    main = f"<article><h1>{title}</h1>{body}{talk}</article>" if style == "article" else f"<div id='content'><h1>{title}</h1>{body}</div>"
    return (f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='</p><p>no</p>';</script></head><body>"
            f"<nav><ul><li><a href='/a'>One</a></li><li>Two</li></ul></nav><!-- x <p>no</p> --><div class=\"ad top\">Buy {title}</div>{extra}{main}"
            f"<aside>More</aside><form><p>Mail?</p></form><div class='cookie-notice'>We store</div><footer>&copy; Us</footer></body></html>")


def test_blocks():
    got = wrappers.read_blocks("<p>a &amp;  b\n<b>c</b><p>d<br>e<ul><li>f<li>g</ul>h &lt;i&gt; <!-- never closed")
    assert got == [("p", "a & b c"), ("p", "d e"), ("ul/li", "f"), ("ul/li", "g"), ("", "h <i>")]
    assert wrappers.read_blocks(None) == [] and wrappers.read_blocks("plain  text") == [("", "plain text")]
    assert wrappers.read_blocks("<div title='a > b'>x</div><script>alert('<p>')") == [("div", "x")]


def test_fold_and_merge_make_groups_and_options():
    nodes = wrappers.fold(list("abcbcbcd"))
    letters = {c: c for c in "abcdxy"}
    assert wrappers.expression(nodes, letters) == "a(?:bc)+d"
    both = wrappers.merge(nodes, wrappers.fold(list("axbcdd")))
    pattern = re.compile(wrappers.expression(both, letters))
    for s in ("abcbcd", "axbcdd", "abcd", "axbcbcddd"):
        assert pattern.fullmatch(s), (s, pattern.pattern)
    assert not pattern.fullmatch("bca")


def test_pages(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for i in range(60):
        style = "article" if i % 2 else "div"
        title, paragraphs = prose(rng, 4), [prose(rng, rng.randint(3, 30)) for _ in range(rng.randint(1, 9))]
        extra = "<div class='x'>Read our terms</div>" if i % 3 else ""
        html = page(title, paragraphs, extra, ["nice"] * (i % 3), style)
        rows.append((i, f"https://{style}.example.org/{i}", html))
        want[i] = "\n".join([title, *paragraphs])
    rows += [(100, None, None), (101, "x", ""), (102, "https://one.example.org/", page("T t", ["only page here"])),
             (103, "https://article.example.org/", "<p>odd"), (None, None, "just text")]
    want |= {100: "", 101: "", 102: "T t\nonly page here", 103: "odd", None: "just text"}
    df = spark.createDataFrame(rows + [rows[0]], "page_id long, url string, html string").repartition(3)
    got = wrappers.main_text(clashing(df)).collect()
    assert len(got) == len(rows) + 1
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert wrappers.main_text(df.limit(0)).count() == 0


def test_names_of_whole_pages_are_no_side_parts():
    text = "<h1>Title here</h1><p>" + "some words of the story " * 9 + "</p>"
    for html in (f"<body class='no-sidebar'><article>{text}</article><div class='sidebar'>Ad</div>",
                 f"<body class='comments-open widget'><main class='post alert' role='search'>{text}</main><div class='share_buttons'>Ad</div>",
                 f"<div id='content' class='with-sidebar'>{text}</div><div class='sidebar-left'>Ad</div>",
                 f"<article class='post comments-open related'>{text}</article><div class='ad-top-2'>Ad</div>",
                 f"<div class='widget alert'>{text}</div><div class='cookie-notice'>Ad</div>"):
        blocks = wrappers.read_blocks(html)
        region, excused = wrappers.main_region(blocks), wrappers.excused_of(blocks)
        got = [t for p, t in blocks if wrappers.in_main(p, region, excused)]
        assert got == ["Title here", " ".join(("some words of the story " * 9).split())], html
    talk = wrappers.read_blocks("<article><h1>Short</h1><section class='comments'><p>" + "long talk " * 50 + "</p></section></article>")
    assert wrappers.excused_of(talk) == frozenset() and wrappers.is_side(talk[1][0])


def test_repeats_at_a_node_are_template(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for i in range(40):
        title, paragraphs = prose(rng, 4), [f"{i} " + prose(rng, 20) for _ in range(3)]
        quoted = "Sign up here today" if i == 7 else f"{i} quoted"  # the notice's words as a page's own text
        main = f"<h1>{title}</h1><div class='x'>Sign up here today</div>" + "".join(f"<p>{p}</p>" for p in paragraphs) + f"<pre>{quoted}</pre>"
        rows.append((i, f"https://notice.example.org/{i}", f"<body><article>{main}</article><div>Terms</div>"))
        want[i] = "\n".join([title, *paragraphs, quoted])
    for i in range(40, 43):  # too few pages: a shared passage stays
        rows.append((i, "https://small.example.org/", f"<div><h1>Page {i}</h1><p>Free to copy under the licence.</p><p>{i} words of its own</p></div>"))
        want[i] = f"Page {i}\nFree to copy under the licence.\n{i} words of its own"
    rows += [(50 + i, "https://notice.example.org/odd", f"<body><div>Not found {i}</div>") for i in range(2)]  # odd pages keep nothing in
    want |= {50: "Not found 0", 51: "Not found 1"}
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    assert {r["page_id"]: r["text"] for r in wrappers.main_text(df).collect()} == want


def test_template_of_each_layout_from_all_pages(spark):
    rows, want = [], {}
    for i in range(60):
        own = f"Story {i} with words of its own"
        if i % 3:  # the same path holds a notice in one layout and the text in the other
            rows.append((i, "https://two.example.org/", f"<article><h1>Title {i}</h1><section>Call us now</section><p>{own}</p></article>"))
            want[i] = f"Title {i}\n{own}"
        else:
            rows.append((i, "https://two.example.org/", f"<article><h1>Title {i}</h1><section>{own}</section><section>more of {i}</section></article>"))
            want[i] = f"Title {i}\n{own}\nmore of {i}"
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    assert {r["page_id"]: r["text"] for r in wrappers.main_text(df).collect()} == want


def test_fields_of_merged_layouts_decide(spark):
    """Every page has a layout of its own; the path of the notice holds a page's own text elsewhere."""
    rng = random.Random(9)
    rows, want = [], {}
    for i in range(32):
        own = [f"{i} {part} " + prose(rng, 8) for part in ("title", "lead", "h2", "pre", "quote", "dl", "end")]
        if i == 9:
            own[-1] = "Call us about our offers"  # the notice's words as a page's own text
        parts = [("h1", True), ("p", True), ("h2", i & 2), ("pre", i & 4), ("blockquote", i & 8), ("dl", i & 16), ("div", True)]
        kept = [(tag, text) for (tag, here), text in zip(parts, own) if here]
        notice = "<div>Call us about our offers</div>" if i & 1 else ""
        rows.append((i, "https://many.example.org/", f"<article>{notice}{''.join(f'<{t}>{x}</{t}>' for t, x in kept)}</article>"))
        want[i] = "\n".join(x for _, x in kept)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    assert {r["page_id"]: r["text"] for r in wrappers.main_text(df).collect()} == want


def random_streams(rng):
    base = [rng.choice("abcde") for _ in range(rng.randint(0, 9))]
    for _ in range(rng.randint(2, 6)):
        yield [c for x in base if rng.random() < 0.85 for c in x * rng.choice([1, 1, 1, 2, 3])] * rng.choice([1, 1, 2])


def test_merged_wrapper_reads_all_streams_as_its_expression():
    rng = random.Random(4)
    letters = {c: c for c in "abcde"}
    for _ in range(300):
        streams = list(random_streams(rng))
        layouts, merged = [wrappers.folded(s) for s in streams], []
        for nodes, fields in layouts:
            assert [wrappers.tokens_of(nodes)[f] for f in fields] == streams[len(merged)]
            merged.append(nodes if not merged else wrappers.merge(merged[-1], nodes))
        machine, pattern = wrappers.automaton(merged[-1]), re.compile(wrappers.expression(merged[-1], letters))
        for s in streams:
            assert [wrappers.tokens_of(merged[-1])[f] for f in wrappers.reads(machine, s)] == s and pattern.fullmatch("".join(s))
        for _ in range(10):
            s = [rng.choice("abcde") for _ in range(rng.randint(0, 6))]
            assert (wrappers.reads(machine, s) is not None) == bool(pattern.fullmatch("".join(s))), (s, pattern.pattern)


def test_repeats_of_parts_of_several_lengths_are_one_group():
    nodes, fields = wrappers.folded("a h p p h p h p p p z".split())
    assert wrappers.expression(nodes, {c: c for c in "ahpz"}) == "a(?:h(?:p)+)+z" and fields == [0, 1, 2, 2, 1, 2, 1, 2, 2, 2, 3]


def test_layouts_of_a_host_merge_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "FAN", 2)
    rows = []
    for host in ("x", "y"):
        for i in range(20):
            stream = ["n", "h1", "p", *[t for k, t in enumerate(("a", "b", "c", "d", "e")) if i >> k & 1], "f"] if host == "x" else ["q"] * (i > 9) + ["r"] * (i < 12)
            nodes = wrappers.fold(stream)
            rows.append((host, wrappers.number(json.dumps(nodes)), json.dumps(nodes, separators=(",", ":"))))
    rows = sorted(set(rows))
    got = wrappers.infer_wrappers(spark.createDataFrame(rows + [("z", 1, None)], "host string, layout long, nodes string")).collect()
    assert sorted((r["host"], r["layout"]) for r in got) == [r[:2] for r in rows]
    assert len({r["wrapper"] for r in got if r["host"] == "x"}) == 1
    nodes = {(h, n): json.loads(x) for h, n, x in rows}
    tokens = {}
    for r in got:  # one token for each field of a wrapper
        for field, token in zip(r["fields"], wrappers.tokens_of(nodes[r["host"], r["layout"]]), strict=True):
            assert tokens.setdefault((r["host"], r["wrapper"], field), token) == token


def test_layouts_too_wide_to_merge_have_their_own_template(spark):
    rng = random.Random(2)
    tags = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(wrappers.WIDTH + 50)]
    rows, want = [], {}
    for i in range(10):
        own = [f"{t} {i}" for t in tags]
        main = "".join(f"<div class='{t}'>{x}</div>" for t, x in zip(tags, own))
        rows.append((i, "https://wide.example.org/", f"<article><section>Sign up</section>{main}</article>"))
        want[i] = "\n".join(own)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    assert {r["page_id"]: r["text"] for r in wrappers.main_text(df).collect()} == want
