"""URL automaton against regular expressions and a plain rule search."""

import random
import re

from cartograph.llm import urlfilter as U
from cartograph.llm.sql import _glob_regex
from tests.llm.conftest import clashing, rows_of

URLS = [
    None, "", "no scheme", "http://", "http:///en/x", "https://Example.COM/en/", "https://example.com/en", "http://www.example.com/en/1?x=/fr/#y",
    "http://a.www.example.com/EN/", "http://xexample.com/en/", "http://net/es/1", "http://m.net/fr/2", "http://m.net/de/fr/", "http://org/en/",
    "http://a.org/.example.com/en/", "http://a.org?.example.com/en/", "http://a.org#.net/es/", "x://b.com", "x://b.com?q", "http://a.net:80/es/",
    "http://u@a.net/es/", "http://a.org/b/login", "http://a.org/login/x", "http://a.org/blogin", "http://a.org/x.mp3", "http://a.org/x.mp3?y",
    "http://a.org/site-search?q=1", "http://a.org/search", "http://mycasino.org/x", "http://é.net/es/", "http://a.org/漢/login", "http://.com/x",
    "first://a.net/es/://b.com/", "http://a.net/" + "es/" * 9000, "http://" + "a." * 9000 + "net/es/", "http://ÄB.com/x\ny", "http://a.org/\n/login",
]


def plain(url):
    head, sep, rest = (url or "").partition("://")
    host = re.split(r"[/?#]", rest)[0] if sep else ""
    path = re.split(r"[?#]", rest[len(host):])[0] if sep else ""
    query = rest[len(host) + len(path):].partition("#")[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in U.HOST_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: len(r.host + r.path))
        return host, path, best.host + best.path, best.verdict, None
    canon = f".{host}{path}{query}" if host else ""
    fits = [g for g in U.GLOBS if re.fullmatch(_glob_regex(g.pattern), canon, re.S)]
    fits.sort(key=lambda g: (-sum(k in ("byte", "one") for k, _ in U.symbols(g.pattern)), g.pattern))
    return host, path, None, fits[0].verdict if fits else "allow", fits[0].pattern if fits else None


def test_verdicts(spark):
    rows = [(i if i % 7 else None, u) for i, u in enumerate(URLS * 2)]
    df = spark.createDataFrame(rows, "page_id long, url string").repartition(3)
    got = U.judge(clashing(df, ("host", "path", "rule", "verdict", "pattern", "__by")))
    assert rows_of(got) == sorted([(i, *plain(u)) for i, u in rows], key=repr)
    assert {r["verdict"] for r in got.collect()} == {"allow", "block"}
    assert U.judge(df.limit(0)).count() == 0


def test_automaton_is_its_globs():
    """Random globs over a few letters, many words wide, against regular expressions."""
    rng = random.Random(3)
    pieces = ["a", "b", "/", ".", "é", "\\?", "*", "**", "?", "[ab]", "[!a]", "[a-c/]", "aab" * 20]
    for _ in range(12):
        globs = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 6))) for _ in range(rng.choice([0, 1, 25]))]
        texts = ["".join(rng.choice(["a", "b", "/", ".", "é", "?", "漢", "aab" * 20]) for _ in range(rng.randint(0, 7))) for _ in range(300)]
        want = [next((i for i, g in enumerate(globs) if re.fullmatch(_glob_regex(g), t, re.S)), -1) for t in texts]
        assert U.Automaton(globs).first_fit([t.encode() for t in texts]).tolist() == want


def test_slices_are_bounded(monkeypatch):
    texts = [b".a.net/es/%d" % i for i in range(50)] + [b"", b"x"]
    whole = U.Automaton(U.ranked()["glob"].tolist()).first_fit(texts)
    monkeypatch.setattr(U, "CELLS", 1)
    assert U.Automaton(U.ranked()["glob"].tolist()).first_fit(texts).tolist() == whole.tolist()


def test_ties_and_own_rules(spark):
    df = spark.createDataFrame([(1, "http://a.b/cd"), (2, "http://a.b*/cd")], "page_id long, url string")
    rules = (U.HostRule("block", "b", "/c"), U.HostRule("allow", "a.b", "/"), U.HostRule("block", "b*", "/"))
    assert [(r["rule"], r["verdict"]) for r in U.judge(df, rules, ()).orderBy("page_id").collect()] == [("a.b/", "allow"), ("b*/", "block")]
    assert {r["verdict"] for r in U.judge(df, (), ()).collect()} == {"allow"}
