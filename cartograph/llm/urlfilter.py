"""URL verdicts by a bit-parallel wildcard automaton.

Every rule is a glob over the canonical URL, ``.host/path?query`` with the scheme and the fragment
cut off and A-Z of the host lower-cased.  The leading dot lets ``*.example.com/`` stand for the host
and all its subdomains.  Glob syntax: ``*`` any run without ``/`` and ``?``; ``**`` any run; ``?`` one
character but ``/``; ``[a-z]`` and ``[!a-z]`` one character of (not of) an ASCII class; ``\\x`` the
character x itself.  All else stands for itself.

All globs are packed side by side into the bits of one multiword mask: a start bit and one bit for
each symbol.  ``step[b]`` holds the bits that byte b may enter, ``stay[b]`` those that it may not
leave (the starred ones).  One byte moves all patterns at once,

    state = ((state << 1) & step[b]) | (state & stay[b])

with the carries of the shift passed on from word to word; a batch of URLs goes through together, so
a task does one array operation a byte position, not one a rule or a URL.  A rule fits if the bit of
its last symbol is set after the last byte.  Rules are ranked beforehand, and the first that fits decides.

Ranks: listed host rules come first, longest ``host/path`` text first (ties: longer host, then text
order); the general globs come after, by their number of plain symbols (ties: text order).  No rule
fits: allowed.

Defined results: a null URL or one without ``://`` has an empty host and path, fits no rule and is
allowed; a very long URL is judged whole (memory is a row of states, time grows with its length);
equal URLs get equal verdicts, row by row; a null key stays null; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CELLS = 1 << 19  # state words that a task holds at once


class HostRule(NamedTuple):
    """Fits a host with all its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str


class Glob(NamedTuple):
    verdict: str
    pattern: str


# fixed values: the listed rules
HOST_RULES = (
    HostRule("allow", "com", "/"), HostRule("block", "example.com", "/en/"), HostRule("allow", "www.example.com", "/en/"),
    HostRule("block", "net", "/es/"), HostRule("block", "net", "/fr/"),
)
# pages that hold no prose: accounts, shops, searches, feeds, files, advert and gambling hosts
GLOBS = (
    *[Glob("block", f"*.*/**/{x}") for x in ("login", "login/**", "signin", "signin/**", "wp-admin/**", "cart", "cart/**", "checkout/**")],
    *[Glob("block", f"*.*/{x}") for x in ("login", "login/**", "signin", "signin/**", "wp-admin/**", "cart", "cart/**", "checkout/**")],
    Glob("block", "*.*/**search\\?**"), Glob("block", "*.*/**/feed"), Glob("block", "*.*/**.rss"),
    *[Glob("block", f"*.*/**.{x}") for x in ("exe", "zip", "iso", "jpg", "jpeg", "png", "gif", "mp[34]")],
    *[Glob("block", f"*.{x}/**") for x in ("doubleclick.*", "ads.*", "*casino*.*", "*porn*.*")],
)


def literal(text: str) -> str:
    """``text`` as a glob that stands for itself."""
    return "".join(f"\\{c}" if c in "*?[\\" else c for c in text)


def symbols(glob: str) -> list[tuple[str, object]]:
    """(kind, value) symbols of a glob: 'byte' b, 'one' allowed ASCII bytes, 'run' or 'all' for stars."""
    out, i = [], 0
    while i < len(glob):
        c = glob[i]
        i += 1
        if c == "*":
            double = glob[i:i + 1] == "*"
            i += double
            out.append(("all" if double else "run", None))
        elif c == "?":
            out.append(("one", (True, set(range(128)) - {ord("/")})))
        elif c == "[":
            end = glob.index("]", i + 1 + (glob[i:i + 1] == "!"))
            body, i = glob[i:end], end + 1
            negated, body = body.startswith("!"), body.removeprefix("!")
            if not body.isascii():
                raise ValueError(f"class of characters beyond ASCII in {glob!r}")
            chosen, k = set(), 0
            while k < len(body):
                spans = body[k + 1:k + 2] == "-" and k + 2 < len(body)
                chosen |= set(range(ord(body[k]), ord(body[k + 2 * spans]) + 1))
                k += 3 if spans else 1
            out.append(("one", (negated, set(range(128)) - chosen if negated else chosen)))
        else:
            if c == "\\":
                c, i = glob[i:i + 1], i + 1
                if not c:
                    raise ValueError(f"nothing after the last backslash of {glob!r}")
            out += [("byte", b) for b in c.encode()]
    return out


class Automaton:
    """All globs in one multiword state; ``glob``s are given in rank order."""

    def __init__(self, globs: list[str]):
        parts = [symbols(g) for g in globs]
        bits = sum(1 + sum(k in ("byte", "one") for k, _ in p) for p in parts)
        self.words = max(1, -(-bits // 64))
        step, stay = np.zeros((256, self.words), np.uint64), np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        ends, at = [], -1

        def put(table, chosen, bit):
            table[np.asarray(sorted(chosen), np.int64), bit // 64] |= np.uint64(1 << bit % 64)

        following = set(range(0x80, 0xC0))  # bytes of a character after its first
        for part in parts:
            at += 1
            self.start[at // 64] |= np.uint64(1 << at % 64)
            for kind, value in part:
                if kind == "byte":
                    at += 1
                    put(step, {value}, at)
                elif kind == "one":
                    beyond, chosen = value
                    at += 1
                    put(step, chosen | (set(range(0xC0, 256)) if beyond else set()), at)
                    put(stay, following if beyond else set(), at)
                else:
                    put(stay, set(range(256)) - (set(b"/?") if kind == "run" else set()), at)
            ends.append(at)
        self.step, self.stay = step, stay
        self.ends = np.asarray(ends, np.int64)

    def first_fit(self, texts: list[bytes]) -> np.ndarray:
        """Rank of the first glob that fits each text, -1 for none."""
        out = np.full(len(texts), -1, np.int64)
        lengths = np.asarray([len(t) for t in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")  # longest first: the texts still running are a head of the slice
        rows = max(1, CELLS // max(self.words, len(self.ends), 1))
        for a in range(0, len(order), rows):
            at = order[a:a + rows]
            out[at] = self._fits(b"".join([texts[i] for i in at]), lengths[at])
        return out

    def _fits(self, data: bytes, lengths: np.ndarray) -> np.ndarray:
        buf = np.frombuffer(data, np.uint8)
        begin = np.cumsum(lengths) - lengths
        state = np.tile(self.start, (len(lengths), 1))
        one, top = np.uint64(1), np.uint64(63)
        running = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), side="left")  # texts longer than t
        for t, k in enumerate(running):
            b, s = buf[begin[:k] + t], state[:k]
            moved = s << one
            moved[:, 1:] |= s[:, :-1] >> top
            state[:k] = (moved & self.step[b]) | (s & self.stay[b])
        if not len(self.ends):
            return np.full(len(lengths), -1, np.int64)
        hit = (state[:, self.ends // 64] >> (self.ends % 64).astype(np.uint64)) & one
        return np.where(hit.any(axis=1), hit.argmax(axis=1), -1)


def ranked(host_rules=HOST_RULES, globs=GLOBS) -> pd.DataFrame:
    """Rules in rank order: glob (over canonical URLs), verdict, rule (of a host rule) and pattern (of a general glob)."""
    listed = sorted(host_rules, key=lambda r: (-len(r.host + r.path), -len(r.host), r.host + r.path, r.verdict))
    general = sorted(globs, key=lambda g: (-sum(k in ("byte", "one") for k, _ in symbols(g.pattern)), g.pattern, g.verdict))
    return pd.DataFrame(
        [(f"*.{literal(r.host + r.path)}**", r.verdict, r.host + r.path, None) for r in listed]
        + [(g.pattern, g.verdict, None, g.pattern) for g in general], columns=["glob", "verdict", "rule", "pattern"])


def url_parts(url: Column) -> dict[str, Column]:
    """host, path and query of a URL, as columns (empty where there is none)."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*+", 0)
    tail = F.substr(rest, F.length(host) + 1)
    path = F.regexp_extract(tail, r"^[^?#]*+", 0)
    query = F.regexp_extract(F.substr(tail, F.length(path) + 1), r"^\?[^#]*+", 0)
    part = {"host": F.translate(host, UPPER, LOWER), "path": path, "query": query}
    return {k: F.coalesce(c, F.lit("")) for k, c in part.items()}


def judge(pages: DataFrame, host_rules=HOST_RULES, globs=GLOBS, key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, rule, verdict and pattern (the general glob that decided, else null) of every row."""
    rules = ranked(host_rules, globs)

    @F.pandas_udf("rule string, verdict string, pattern string")
    def decide(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(rules["glob"].tolist())
        for urls in batches:
            rank = automaton.first_fit([u.encode() for u in urls])
            chosen = rules[["rule", "verdict", "pattern"]].reindex(rank).reset_index(drop=True)
            chosen["verdict"] = chosen["verdict"].where(rank >= 0, "allow")
            yield chosen.astype(object).where(chosen.notna(), None)

    parts = url_parts(F.col(f"`{url}`"))
    host, path = parts["host"], parts["path"]
    canonical = F.when(host == "", F.lit("")).otherwise(F.concat(F.lit("."), host, path, parts["query"]))
    return (pages.select(F.col(f"`{key}`").alias(key), host.alias("host"), path.alias("path"), decide(canonical).alias("__by"))
            .select(key, "host", "path", F.col("__by.rule").alias("rule"), F.col("__by.verdict").alias("verdict"),
                    F.col("__by.pattern").alias("pattern")))
