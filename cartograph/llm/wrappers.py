"""HTML extraction by union-free regular-expression wrappers.

Pages of a host are read as token streams: one token per text block, its path of block elements.
``folded`` makes a stream an expression (adjacent repeats are groups): the page's layout.  All layouts
of a host are aligned and merged (``infer_wrappers``): nodes that align stay, others are optional.
Layouts that hardly align, or whose merged wrapper would pass WIDTH fields, keep wrappers of their
own (a layout of more fields is its only wrapper).  The automaton of the merged expression reads every layout, which gives each block of a page a
field.  The texts of every field are counted over all distinct pages of the wrapper, and over those of
each layout: a text that nearly all pages with the field hold there is template, inside an article
too, and all other texts are slots.  No page is left out of the counts.  The main text of a page is
the slots of its main region; names of elements only settle which slots belong to menus, adverts,
comments and the like.  A field that fewer than LEAST_PAGES distinct pages have is judged with the
host's other fields of its path; where those are too few as well, the region and the names decide alone.

Defined results: null, empty and tagless html give their text as one block, if any; a null url is a
host of its own; unclosed comments, scripts and tags end with the page; equal rows give equal rows;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import json
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, reduce
from hashlib import blake2b

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartograph.session import materialize

LEAST_PAGES = 8  # distinct pages with a field from which on its repeated texts are template
TEMPLATE_SHARE = 0.8  # share of them that must hold the text at the field
FAN = 32  # wrappers merged by one group of a round
WIDTH = 1000  # fields of a wrapper up to which it is merged with others
MAX_BROADCAST_FRAMES = 20_000
MAX_BROADCAST_CHARS = 16_000_000

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|select|textarea|button|title)\b(?>[^<>\"']+|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>[^<>\"']+|\"[^\"]*\"|'[^']*')*+)>|<[/!?a-zA-Z][^>]*(?:>|\Z)|([^<]+|<)", re.S | re.I)
NAMES = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)

# fixed values: HTML element names and usual names of page parts
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header html head hr legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
CLOSES_P = BLOCK
SIBLINGS = {"li": "li", "dt": "dd dt", "dd": "dd dt", "tr": "tr td th", "td": "td th", "th": "td th"}
SIDE_TAGS = frozenset("nav footer aside form head menu dialog fieldset".split())
SIDE_NAMES = frozenset("""ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies
disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo
promoted related reply replies respond responses search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget widgets
navigation contentinfo complementary search alert""".split())
HEAD_NAMES = frozenset("header masthead topbar".split())
NEUTRAL = frozenset("""area bar block bottom box button buttons container form global group inner items left link links list outer page panel
posts primary right row secondary section site sticky text title top wrap wrapper""".split())  # parts of a compound name that leave its sense
MAIN_NAMES = frozenset("article main".split())
WHOLE = MAIN_NAMES | {"html", "body"}  # elements whose class, id and role say nothing of their part


def signature(tag: str, attrs: str) -> str:
    """Element name with the class, id and role tokens, without digits; ``!`` marks hidden ones."""
    tag = tag.lower()
    if not attrs or attrs.isspace():
        return tag
    words, hidden = [], False
    for name, value in NAMES.findall(attrs):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id", "role"):
            words += [w for x in value.split() if (w := re.sub(r"[^a-z-]+", "", x.replace("_", "-")).strip("-"))]
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
            hidden = True
    return ".".join([tag, *dict.fromkeys(words)]) + "!" * hidden


def read_blocks(page: str | None) -> list[tuple[str, str]]:
    """(path, text) of the text blocks of a page in order; white space in a text is one space."""
    out: list[tuple[str, str]] = []
    if not page:
        return out
    stack: list[tuple[str, str]] = []
    buffer: list[str] = []

    def flush():
        if buffer:
            text = " ".join(html_lib.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                out.append(("/".join(s for _, s in stack), text))

    for m in TOKEN.finditer(page):
        if m[5] is not None:
            buffer.append(m[5])
            continue
        tag = m[3]
        if tag is None:
            if m[1] and m[1].lower() in ("script", "style", "title"):
                continue
            buffer.append(" ") if m[1] else None
            continue
        tag = tag.lower()
        if tag == "br":
            buffer.append(" ")
        if tag not in BLOCK:
            continue
        flush()
        if m[2]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        if stack and stack[-1][0] == "p" and tag in CLOSES_P:
            stack.pop()
        if stack and stack[-1][0] in SIBLINGS.get(tag, "").split():
            stack.pop()
        if tag not in VOID:
            stack.append((tag, signature(tag, m[4])))
    flush()
    return out


def steps(path: str) -> list[tuple[str, set]]:
    return [(s.rstrip("!").split(".")[0], set(s.rstrip("!").split(".")[1:])) for s in path.split("/")] if path else []


def named_as(names: set, kinds: frozenset) -> bool:
    """Is one of the names, as a whole, of these kinds?  ``cookie-notice`` and ``sidebar-left`` are, ``no-sidebar`` is not."""
    return any(n in kinds or ("-" in n and (parts := {x for x in n.split("-") if x}) & kinds and parts <= kinds | NEUTRAL) for n in names)


@lru_cache(maxsize=100_000)
def is_side(path: str, excused: frozenset = frozenset()) -> bool:
    """Does the path lead through a menu, header, footer, sidebar, notice, advert, form or comment?
    Names of html, body, main, article and of the ``excused`` path prefixes do not count."""
    inside, at = False, ""
    if "!" in path:
        return True
    for part, (tag, names) in zip(path.split("/"), steps(path)):
        at = f"{at}/{part}" if at else part
        if tag in WHOLE or at in excused:
            names = set()
        if tag in SIDE_TAGS or named_as(names, SIDE_NAMES):
            return True
        if not inside and (tag == "header" or named_as(names, HEAD_NAMES)):
            return True
        inside = inside or tag in MAIN_NAMES
    return False


def excused_of(blocks: list[tuple[str, str]]) -> frozenset:
    """Path prefixes that a name calls a side part although they hold most of the page's text, with
    no article, main or h1 outside."""
    weight: Counter = Counter()
    heads, total = [], 0
    for path, text in blocks:
        parts, tags = path.split("/"), [t for t, _ in steps(path)]
        if "!" in path or SIDE_TAGS & set(tags):
            continue
        total += len(text)
        if tags and (tags[-1] == "h1" or MAIN_NAMES & set(tags)) and "header" not in tags:
            heads.append(path + "/")
        for k in range(1, len(parts) + 1):
            weight["/".join(parts[:k])] += len(text)
    return frozenset(p for p, n in weight.items() if 2 * n > total and p
                     and named_as(steps(p)[-1][1], SIDE_NAMES | HEAD_NAMES) and all(h.startswith(p + "/") for h in heads))


def main_region(blocks: list[tuple[str, str]], excused: frozenset | None = None) -> str:
    """Path prefix of the main part: the article or main element, else the deepest element that
    holds most of the text outside side parts."""
    excused = excused_of(blocks) if excused is None else excused
    weight: Counter = Counter()
    for path, text in blocks:
        if is_side(path, excused):
            continue
        parts = path.split("/")
        for k in range(len(parts) + 1):
            weight["/".join(parts[:k])] += len(text)
    named = [p for p in weight if p and steps(p)[-1][0] in MAIN_NAMES]
    if named:
        return max(named, key=lambda p: (weight[p], -len(p)))
    at = ""
    while True:
        deeper = [p for p in weight if p.rpartition("/")[0] == at and p != at and weight[p] >= 0.6 * weight[at]
                  and steps(p)[-1][0] not in ("p", "h1", "h2", "h3", "li", "ul", "ol", "blockquote", "pre")]
        if not deeper:
            return at
        at = max(deeper, key=lambda p: weight[p])


# ------------------------------------------------------------------ wrappers
# A wrapper is a list of nodes [kind, body, optional]: kind "t" (body: token) or "g" (body: nodes,
# a repeated group; one node in it is a token).  Its fields are its tokens, numbered in order.

def folded(tokens: list) -> tuple[list, list[int]]:
    """Nodes of a stream, adjacent repeats folded into groups, shortest periods first, and the field of every token."""
    nodes, keys, trees = [["t", t, False] for t in tokens], list(tokens), list(range(len(tokens)))
    period = 1
    while period <= max(1, len(nodes) // 2) and period <= 8:
        i, out, kept, below, again = 0, [], [], [], False
        while i < len(nodes):
            j = i + period
            while j + period <= len(nodes) and keys[j:j + period] == keys[i:i + period]:
                j += period
            if j > i + period:
                body = [reduce(either, nodes[i + k:j:period]) for k in range(period)]
                if period == 1 and body[0][0] == "g":
                    out.append(body[0])
                    below.append([x for t in trees[i:j] for x in ([[t]] if isinstance(t, int) else t)])
                else:
                    out.append(["g", body, False])
                    below.append([trees[k:k + period] for k in range(i, j, period)])
                kept.append(key(out[-1]))
                i, again = j, True
            else:
                out.append(nodes[i])
                kept.append(keys[i])
                below.append(trees[i])
                i += 1
        nodes, keys, trees = out, kept, below
        period = 1 if again and period > 1 else period + 1
    fields, at = [0] * len(tokens), 0
    for node, tree in zip(nodes, trees):
        at = number_fields(node, tree, at, fields)
    return nodes, fields


def number_fields(node: list, tree, at: int, fields: list[int]) -> int:
    """Write the fields of the tokens below a node, from field ``at`` on; returns the next field."""
    if node[0] == "t":
        fields[tree] = at
        return at + 1
    for row in [[tree]] if isinstance(tree, int) else tree:
        end = at
        for below, part in zip(node[1], row):
            end = number_fields(below, part, end, fields)
    return end


def fold(tokens: list) -> list:
    """Nodes of a stream, adjacent repeats folded into groups."""
    return folded(tokens)[0]


def key(node) -> str:
    """Shape of a node: a repeated token is like a single one, an option like what always stands."""
    if node[0] == "t":
        return node[1]
    return key(node[1][0]) if len(node[1]) == 1 else "(" + ",".join(map(key, node[1])) + ")"


def either(a: list, b: list) -> list:
    """The node that reads what either of two nodes of one shape reads."""
    if a[0] == b[0]:
        return [a[0], a[1] if a[0] == "t" else [either(x, y) for x, y in zip(a[1], b[1])], a[2] or b[2]]
    group, single = (a, b) if a[0] == "g" else (b, a)
    return ["g", group[1], group[2] or single[2]]


def units(nodes: list) -> list:
    """Bodies of the repeated groups of several tokens, longest first."""
    found = [x for n in nodes if n[0] == "g" for x in ([n[1]] if len(n[1]) > 1 else []) + units(n[1])]
    return sorted(found, key=len, reverse=True)


def grouped(nodes: list, bodies: list) -> list:
    """``nodes`` with single occurrences of the bodies made groups."""
    for body in bodies:
        shape, keys = [key(n) for n in body], [key(n) for n in nodes]
        i, out = 0, []
        while i < len(nodes):
            if keys[i:i + len(body)] == shape:
                out.append(["g", [either(x, y) for x, y in zip(nodes[i:i + len(body)], body)], False])
                i += len(body)
            else:
                out.append(nodes[i])
                i += 1
        nodes = out
    return nodes


def aligned(a: list, b: list) -> tuple[list, int]:
    """Two wrappers as one that reads both: common nodes stay (a repeat on either side makes a group),
    others become optional; and the number of common nodes.  Nodes that stand once on either side are
    aligned first, as many as can be."""
    a, b = grouped(a, units(b)), grouped(b, units(a))
    ka, kb = [key(x) for x in a], [key(x) for x in b]
    n, m = len(a), len(b)
    na, nb = Counter(ka), Counter(kb)
    worth = [n + m if na[k] == nb[k] == 1 else 1 for k in ka]
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, below, one, gain = best[i], best[i + 1], ka[i], worth[i]
        for j in range(m - 1, -1, -1):
            row[j] = max(below[j], row[j + 1], below[j + 1] + gain if one == kb[j] else 0)
    out, common, i, j = [], 0, 0, 0
    while i < n or j < m:
        if i < n and j < m and ka[i] == kb[j] and best[i][j] == best[i + 1][j + 1] + worth[i]:
            out.append(either(a[i], b[j]))
            i, j, common = i + 1, j + 1, common + 1
        elif j >= m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append([a[i][0], a[i][1], True])
            i += 1
        else:
            out.append([b[j][0], b[j][1], True])
            j += 1
    return out, common


def merge(a: list, b: list) -> list:
    """One wrapper that reads what either of two reads."""
    return aligned(a, b)[0]


def expression(nodes: list, letters: dict) -> str:
    """The wrapper as a regular expression over one letter per token."""
    out = ""
    for kind, body, optional in nodes:
        one = letters[body] if kind == "t" else f"(?:{expression(body, letters)})+"
        out += f"(?:{one})?" if optional else one
    return out


def tokens_of(nodes: list) -> list:
    """Token of every field."""
    return [t for kind, body, _ in nodes for t in ([body] if kind == "t" else tokens_of(body))]


def stream_of(nodes: list, at: int = 0) -> list[tuple[str, int]]:
    """(token, field) of a stream that the wrapper reads, with every option and with two rounds of every repeat."""
    out = []
    for kind, body, _ in nodes:
        part = [(body, at)] if kind == "t" else stream_of(body, at)
        at = part[-1][1] + 1
        out += part if kind == "t" else part * 2
    return out


def automaton(nodes: list) -> tuple[dict, list[set], set, set, bool]:
    """The wrapper's expression as an automaton over its fields: fields of every token, the fields
    that may follow each field, those that may come first, those that may come last, and whether it
    reads an empty stream."""
    follow: list[set] = []
    where: dict = {}

    def read(nodes):
        first, last, empty = set(), set(), True
        for kind, body, optional in nodes:
            if kind == "t":
                begin, end, skip = {len(follow)}, {len(follow)}, optional
                where.setdefault(body, []).append(len(follow))
                follow.append(set())
            else:
                begin, end, skip = read(body)
                skip = skip or optional
                for x in end:
                    follow[x] |= begin
            for x in last:
                follow[x] |= begin
            first = first | begin if empty else first
            last = last | end if skip else end
            empty = empty and skip
        return first, last, empty

    first, last, empty = read(nodes)
    return where, follow, first, last, empty


def reads(machine: tuple, tokens: list) -> list[int] | None:
    """Field that reads each token of a stream (the first fields where there is a choice); None: not read."""
    where, follow, first, last, empty = machine
    came: list[dict] = []
    if not tokens:
        return [] if empty else None
    for i, token in enumerate(tokens):
        now = {}
        for field in where.get(token, ()):
            before = field in first if i == 0 else next((x for x in came[-1] if field in follow[x]), None)
            if before is not None and before is not False:
                now[field] = before
        came.append(now)
    at = next((x for x in came[-1] if x in last), None)
    if at is None:
        return None
    out = []
    for now in reversed(came):
        out.append(at)
        at = now[at]
    return out[::-1]


def classes(wrappers: list[tuple[int, list]]) -> list[tuple[int, list, list[int]]]:
    """(number, wrapper, numbers read by it): wrappers merged where at least half of the smaller one's
    nodes align and the result has no more than WIDTH fields."""
    out: list = []
    for one, nodes in sorted(wrappers, key=lambda w: (-len(w[1]), w[0])):
        for i, (name, other, members) in enumerate(out):
            both, common = aligned(other, nodes)
            if common and 2 * common >= min(len(other), len(nodes)) and len(tokens_of(both)) <= WIDTH:
                out[i] = (name, both, [*members, one])
                break
        else:
            out.append((one, nodes, [one]))
    return out


def in_main(path: str, region: str, excused: frozenset = frozenset()) -> bool:
    return not is_side(path, excused) and (not region or path == region or path.startswith(region + "/"))


def main_blocks(blocks: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Blocks of the main region, by element names and sizes alone."""
    excused = excused_of(blocks)
    region = main_region(blocks, excused)
    return [b for b in blocks if in_main(b[0], region, excused)]


def extract(page: str | None, frame: frozenset = frozenset()) -> str:
    """Main text: the slots (blocks that are not in the ``frame`` of template (field, text) pairs) of
    the main region in page order.  Where the frame would take the larger part of the region, the
    host's pages repeat their own text, and the region stays whole."""
    blocks = read_blocks(page)
    by_names = main_blocks(blocks)
    if not frame:
        return "\n".join(t for _, t in by_names)
    _, fields = folded([path for path, _ in blocks])
    slots = [b for b, field in zip(blocks, fields) if (field, number(b[1])) not in frame]
    good, left = main_blocks(slots), Counter(slots)
    taken = sum(len(t) * n for (_, t), n in (Counter(by_names) - left).items())
    good = by_names if 2 * taken > sum(len(t) for _, t in by_names) or not good else good
    return "\n".join(t for _, t in good)


def number(value: str) -> int:
    """64-bit digest, never 0."""
    return int.from_bytes(blake2b(value.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True) or 1


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def layout_of(blocks: list[tuple[str, str]]) -> tuple[int, str | None, list[int]]:
    """Digest and nodes (none beyond WIDTH fields) of the folded path stream, and the field of every
    block: pages that differ only in the lengths of repeats have one layout."""
    nodes, fields = folded([path for path, _ in blocks])
    text = json.dumps(nodes, separators=(",", ":"))
    return number(text), text if max(fields, default=0) < WIDTH else None, fields


def streams(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Host, digest, layout, layout's nodes and path digest of each field of the pages, and (field, text
    digest) pairs of their blocks, with text 0 once for each field."""
    for part in parts:
        rows = []
        for host, html in zip(part["host"], part["html"]):
            blocks = read_blocks(html)
            layout, nodes, fields = layout_of(blocks)
            pairs = sorted({(f, number(t)) for f, (_, t) in zip(fields, blocks)} | {(f, 0) for f in fields})
            paths = [number(path) for _, path in sorted({f: path for f, (path, _) in zip(fields, blocks)}.items())]
            rows.append((host, number(repr(blocks)), layout, nodes, paths, [f for f, _ in pairs], [t for _, t in pairs]))
        yield pd.DataFrame(rows, columns=["host", "page", "layout", "nodes", "paths", "field", "text"])


def merge_bucket(group: pd.DataFrame) -> pd.DataFrame:
    """(host, wrapper, into, nodes) of some wrappers of a host; nodes stand once for each merged wrapper."""
    rows, host = [], group["host"].iloc[0]
    for into, nodes, members in classes([(w, json.loads(n)) for w, n in zip(group["wrapper"], group["nodes"])]):
        rows += [(host, w, into, json.dumps(nodes, separators=(",", ":")) if w == into else None) for w in members]
    return pd.DataFrame(rows, columns=["host", "wrapper", "into", "nodes"])


@lru_cache(maxsize=1000)
def machine_of(nodes: str) -> tuple:
    return automaton(json.loads(nodes))


def read_layouts(layouts: pd.Series, wrappers: pd.Series) -> pd.Series:
    """Field of the wrapper for every field of the layout that it reads."""
    out = []
    for layout, wrapper in zip(layouts, wrappers):
        stream = stream_of(json.loads(layout))
        at = dict(zip([f for _, f in stream], reads(machine_of(wrapper), [t for t, _ in stream])))
        out.append([at[f] for f in range(len(at))])
    return pd.Series(out, dtype=object)


def infer_wrappers(layouts: DataFrame) -> DataFrame:
    """(host, layout, wrapper, fields): the union-free expression that reads a layout, and its field
    for every field of the layout.  ``layouts`` holds host, layout and nodes; none without nodes returns.

    All layouts of a host are merged, FAN at a time and the results again, so that no host is in one
    task; it ends when a host's wrappers fit one merge, or when the wrappers left hardly align.
    """
    layouts = layouts.where("nodes is not null")
    now = layouts.withColumnRenamed("layout", "wrapper")
    members = layouts.select("host", "layout", F.col("layout").alias("wrapper"))
    turn = 0
    while True:
        sizes = now.groupBy("host").agg(F.count("*").alias("n"))
        before, most = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
        if most <= 1:
            break
        bucket = F.pmod(F.xxhash64("wrapper", F.lit(turn)), F.ceil(F.col("n") / FAN))
        merged = materialize(now.join(sizes, "host").withColumn("bucket", bucket).groupBy("host", "bucket")
                             .applyInPandas(merge_bucket, "host string, wrapper long, into long, nodes string"), f"wrapper-merge-{turn}")
        members = members.join(merged.select("host", "wrapper", "into"), ["host", "wrapper"]).select("host", "layout", F.col("into").alias("wrapper"))
        now = merged.where("nodes is not null").select("host", F.col("into").alias("wrapper"), "nodes")
        turn += 1
        if most <= FAN or now.count() > 0.9 * before:
            break
    both = members.join(layouts, ["host", "layout"]).join(now.withColumnRenamed("nodes", "expression"), ["host", "wrapper"])
    return materialize(both.select("host", "layout", "wrapper", F.pandas_udf(read_layouts, "array<int>")("nodes", "expression").alias("fields")),
                       "wrapper-fields")


def marks_of(kind: str, of: Column, at: str | None) -> Column:
    """The distinct (field, text) pairs of a page, its layout's fields as numbered by the array ``at``."""
    pairs = F.zip_with("field", "text", lambda f, t: F.struct((F.get(F.col(at), f) if at else f).cast("long").alias("field"), t.alias("text")))
    return F.struct(F.lit(kind).alias("kind"), of.alias("of"), F.array_distinct(pairs).alias("marks"))


def infer_frames(pages: DataFrame) -> DataFrame:
    """(host, layout, frame): template (field, text) pairs of every layout of a host, counted over
    all distinct pages that the layout's wrapper reads, and over those of the layout itself.

    A text is template at a field if TEMPLATE_SHARE of the wrapper's (layout's) pages with that field
    hold it there, and LEAST_PAGES or more have the field.  Fields that fewer pages have, and those of
    layouts too wide for a wrapper, are judged together with the host's other fields of their path.
    Counts are by (host, wrapper or layout, field, text): no host is in one task.
    """
    seen = materialize(pages.select(host_of(F.col("url")).alias("host"), "html")
                       .mapInPandas(streams, "host string, page long, layout long, nodes string, paths array<long>, field array<int>, text array<long>")
                       .dropDuplicates(["host", "page"]), "wrapper-pages")
    layouts = materialize(seen.select("host", "layout", "nodes", "paths").dropDuplicates(["host", "layout"]), "wrapper-layouts")
    read = infer_wrappers(layouts.select("host", "layout", "nodes"))
    kinds = [marks_of("field", F.col("wrapper"), "fields"), marks_of("path", F.lit(0).cast("long"), "paths"), marks_of("layout", F.col("layout"), None)]
    marks = seen.join(read, ["host", "layout"], "left").select("host", F.explode(F.array(*kinds)).alias("m")).where("m.of is not null") \
        .select("host", "m.kind", "m.of", F.explode("m.marks").alias("m")).select("host", "kind", "of", "m.field", "m.text")
    least, at = math.ceil(LEAST_PAGES * TEMPLATE_SHARE), ["host", "kind", "of", "field"]
    counted = materialize(marks.groupBy(*at, "text").agg(F.count("*").alias("n"))
                          .where(F.col("n") >= F.when(F.col("text") == 0, LEAST_PAGES).otherwise(least)), "wrapper-counts")
    held = counted.where("text = 0").select(*at, F.col("n").alias("pages"))
    template = counted.where("text <> 0").join(held, at).where(F.col("n") >= F.col("pages") * TEMPLATE_SHARE).select(*at, "text")
    own = layouts.join(read, ["host", "layout"], "left").select("host", "layout", F.col("wrapper").alias("of"), "fields", F.posexplode("paths").alias("own", "path")) \
        .select("host", "layout", "of", "own", "path", F.get("fields", F.col("own")).cast("long").alias("field"))
    of_field = own.join(template.where("kind = 'field'"), ["host", "of", "field"])
    rare = own.join(held.where("kind = 'field'"), ["host", "of", "field"], "left_anti").select("host", "layout", "own", F.col("path").alias("field"))
    of_path = rare.join(template.where("kind = 'path'"), ["host", "field"])
    of_wrapper = of_field.select("host", "layout", F.col("own").cast("long").alias("field"), "text") \
        .unionByName(of_path.select("host", "layout", F.col("own").cast("long").alias("field"), "text"))
    of_layout = template.where("kind = 'layout'").select("host", F.col("of").alias("layout"), "field", "text")
    return materialize(of_wrapper.unionByName(of_layout).groupBy("host", "layout")
                       .agg(F.concat_ws(",", F.sort_array(F.collect_set(F.concat_ws(":", "field", "text")))).alias("frame")),
                       "wrapper-frames")


def layouts(pages: pd.Series) -> pd.Series:
    return pd.Series([layout_of(read_blocks(p))[0] for p in pages], dtype="int64")


def extracted(pages: pd.Series, frames: pd.Series) -> pd.Series:
    known: dict = {}
    out = []
    for page, f in zip(pages, frames):
        if f not in known:
            known[f] = frozenset(tuple(map(int, x.split(":"))) for x in f.split(",")) if f else frozenset()
        out.append(extract(page, known[f]))
    return pd.Series(out, dtype=object)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html)."""
    pages = pages.select("page_id", "url", "html")
    frames = infer_frames(pages).select(F.col("host").alias("__host"), F.col("layout").alias("__layout"), F.col("frame").alias("__frame"))
    n, size = frames.agg(F.count("*"), F.coalesce(F.sum(F.length("__frame")), F.lit(0))).first()
    few = n <= MAX_BROADCAST_FRAMES and size <= MAX_BROADCAST_CHARS
    out = pages.withColumns({"__h": host_of(F.col("url")), "__l": F.pandas_udf(layouts, "long")("html")})
    out = out.join(F.broadcast(frames) if few else frames, (F.col("__h") == F.col("__host")) & (F.col("__l") == F.col("__layout")), "left")
    out = out.withColumn("text", F.pandas_udf(extracted, "string")("html", F.coalesce("__frame", F.lit(""))))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
