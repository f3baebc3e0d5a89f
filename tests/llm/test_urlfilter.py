import random

import pytest

from veridq.llm import urlfilter as U

RULES = [("org", "/", True), ("example.org", "/es/", False), ("Example.org", "/en/1", False), ("com", "/fr/", True), ("com", "/de/", False)]


def split(url):
    if url is None or "://" not in url:
        return "", "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host, rest = rest[:cut].lower(), rest[cut:].split("#")[0]
    path, mark, query = rest.partition("?")
    return host, path, mark + query if query else ""


def key(url):
    h, p, q = split(url)
    return (h, p or "/", q) if h else None


def rule(url, rules):
    h, p, _ = split(url)
    fit = [(len(a + b), len(a), ok, a.lower() + b) for a, b, ok in rules if h and (h == a.lower() or h.endswith("." + a.lower())) and p.startswith(b)]
    return max(fit) if fit else None


def brute(pages, links, rules):
    near = {}
    for a, b in links:
        a, b = (a, key(a)), (b, key(b))
        if a[1] and b[1]:
            near.setdefault(a[1], set()).add(b[1])
            near.setdefault(b[1], set()).add(a[1])
    urls = {key(u): u for pair in links for u in pair if key(u)}
    todo = [k for k, u in urls.items() if k in near and (rule(u, rules) or (0, 0, True))[2] is False]
    bad = set(todo)
    while todo:
        for k in near.get(todo.pop(), ()):
            if k not in bad:
                bad.add(k)
                todo.append(k)
    out = []
    for i, u in pages:
        r = rule(u, rules)
        verdict = r[2] if r else key(u) not in bad
        out.append((i, *split(u)[:2], r[3] if r else None, "allow" if verdict else "block"))
    return sorted(out, key=str)


@pytest.mark.parametrize("in_row", [256, 2])
def test_matches_brute_force(spark, monkeypatch, in_row):
    monkeypatch.setattr(U, "IN_ROW", in_row)
    rng = random.Random(7)
    hosts = ["a.net", "b.net", "www.b.net", "foo.com", "x.example.org", "example.org", "EXAMPLE.org:80", "org", "notorg", "c.io", "d.io"]
    paths = ["", "/", "/de/1", "/fr/", "/es/x", "/en/12", "/en/2", "/q"]
    url = lambda: f"{rng.choice(['http', 'https'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?', '?a=1', '#t', '?a=1#?x'])}"
    pages = [(i, url()) for i in range(200)] + [(900, None), (901, "nope"), (902, ""), (903, "://"), (None, "http://foo.com/de/"), (5, "http://a.net/"), (5, "http://a.net/")]
    log = [(url(), url()) for _ in range(25)] + [("http://z.io/hub", f"http://z{i}.io/") for i in range(50)] + [("http://z7.io/", "http://foo.com/de/9"), (None, "http://a.net/"), ("x", "y"), ("http://e.io/", "http://e.io/#s")]
    log += [(f"http://chain.io/{i}", f"http://chain.io/{i + 1}") for i in range(60)] + [("http://chain.io/60", "http://w.foo.com/de/")]
    pages += [(1000 + i, f"http://z{i}.io") for i in range(3)] + [(2000, "https://chain.io/0"), (2001, "http://e.io/")]
    df = spark.createDataFrame([(i, u, "<p>x</p>", "r", "k") for i, u in pages], "page_id long, url string, html string, rule string, key string")
    got = U.judge(df, spark.createDataFrame(RULES, U.RULE), spark.createDataFrame(log, "from_url string, to_url string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(pages, log, RULES)


LINKS = [
    ("http://a.net/x/y.html", "<link rel=canonical href='../z'>", "http://a.net/z"),
    ("http://a.net/x/y.html", '<LINK HREF="./w?u=1&amp;v=2" REL="shortlink Canonical">', "http://a.net/x/w?u=1&v=2"),
    ("http://a.net", '<link rel="canonical" href="p">', "http://a.net/p"),
    ("http://a.net/b?q", '<link rel="canonical" href="?r">', "http://a.net/b?r"),
    ("https://a.net/b", '<link rel="canonical" href="//C.net/d">', "http://C.net/d"),
    ("https://a.net/b", '<meta http-equiv="refresh" content="0; URL=\'https://c.net/e\'">', "https://c.net/e"),
    ("https://a.net/b", '<base href="http://c.net/f/"><link rel="canonical" href="g/../h">', "http://c.net/f/h"),
    ("https://a.net/b", '<link rel="canonical" href="mailto:me@a.net">', None),
    ("https://a.net/b", '<link rel="canonicals" href="/c">', None),
    ("https://a.net/b", '<link rel="icon" href="/canonical">', None),
    ("https://a.net/b", '<!-- <link rel="canonical" href="/c"> -->', None),
    ("https://a.net/b", '<script>"<link rel=canonical href=/c>"</script>', None),
    ("https://a.net/b", '<body><link rel="canonical" href="/c">', None),
    ("https://a.net/b", '<meta http-equiv="refresh" content="30">', None),
    ("nowhere", '<link rel="canonical" href="http://c.net/">', None),
    (None, '<link rel="canonical" href="http://c.net/">', None),
    ("https://a.net/b", None, None),
]


def test_links_of_pages(spark):
    df = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(LINKS)], "page_id long, url string, html string")
    got = sorted((r.from_url, r.to_url) for r in U.page_links(df).collect())
    assert got == sorted((u, t) for u, _, t in LINKS if t)


def test_blocks_spread_along_page_links(spark):
    pages = [
        (1, "http://a.net/1", '<link rel="canonical" href="http://foo.com/de/x">'),  # alias of a blocked URL
        (2, "http://b.org/1", '<link rel="canonical" href="http://foo.com/de/x">'),  # allowed by its own rule
        (3, "http://c.net/1", '<link rel="canonical" href="http://b.org/1">'),  # reached through it
        (4, "http://d.net/1", '<link rel="canonical" href="http://d.net/2">' + "x" * 300_000),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rules = spark.createDataFrame(RULES, U.RULE)
    assert {r.page_id: r.verdict for r in U.judge(df, rules).collect()} == {1: "block", 2: "allow", 3: "block", 4: "allow"}
    assert U.judge(df.limit(0), rules).collect() == []
    assert {r.verdict for r in U.judge(df, rules.limit(0)).collect()} == {"allow"}
