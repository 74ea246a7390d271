import random
import re

import pytest

from trackloom.llm import urls


def judge(spark, given, filters=urls.UrlFilter()):
    df = spark.createDataFrame([(k, u) for k, u in enumerate(given)], "page_id long, url string")
    rows = urls.filter_urls(df, given=filters).collect()
    return [r for r in sorted(rows, key=lambda r: r.page_id)]


def brute(url, filters):
    """Term by term and rule by rule."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    lower = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    host, low = lower(host), lower(url or "")
    fits = [
        (len(h) + len(p), len(h), h + p, v) for h, p, v in filters.rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]

    def seen(term):
        return any(
            not (k and low[k - 1].isalnum()) and not low[k + len(term): k + len(term) + 1].isalnum()
            for k in range(len(low)) if low.startswith(term, k)
        )

    strict, soft = (sorted(t for t in kind if seen(t)) for kind in (filters.strict, filters.soft))
    blocked = bool(strict) or len(soft) >= filters.soft_hits
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "block" if blocked else "allow", strict, soft


def test_rules_and_terms(spark):
    given = {
        "http://a.example.org/es/1": ("example.org/es/", "block"),
        "http://EXAMPLE.org/en/1x": ("example.org/en/1", "block"),
        "http://badexample.org/es/1": ("org/", "allow"),
        "http://org/": ("org/", "allow"),
        "http://example.org": (None, "allow"),  # no path, so no rule fits
        "https://x.com/fr/casino": ("com/fr/", "allow"),
        "https://x.com/de/": ("com/de/", "block"),
        "https://x.com/DE/": (None, "allow"),
        "https://casino.net/": (None, "block"),
        "https://casinos.net/": (None, "allow"),
        "https://x.net/cheap/cheap": (None, "allow"),
        "https://x.net/cheap_pills": (None, "block"),
        "https://x.net/?q=CHEAP+Pills": (None, "block"),
        "https://x.net/cheaper-pills": (None, "allow"),
        "https://x.net/écasino": (None, "allow"),
        "casino": (None, "block"),
        "": (None, "allow"),
        None: (None, "allow"),
        "://": (None, "allow"),
        "a://b://c.com/de/": (None, "allow"),
    }
    rows = judge(spark, given)
    assert {u: (r.rule, r.verdict) for u, r in zip(given, rows)} == given
    assert [(r.host, r.path) for r in rows[-4:]] == [("", ""), ("", ""), ("", ""), ("b:", "//c.com/de/")]


def test_against_brute_force(spark):
    draw = random.Random(4)
    filters = urls.UrlFilter(
        rules=[("com", "/", "allow"), ("b.com", "", "block"), ("a.b.com", "/x", "allow"), ("com", "/x/yyyyy", "block"), ("", "/x", "block")],
        strict=("bad", "bad-ad"), soft=("ad", "soft", "oft", "ly ly"), soft_hits=2,
    )
    parts = ["a", "b", "com", ".", "/", "x", "y", "?", "#", "://", "bad", "-", "ad", "soft", "oft", "É", "ly ly", "7", "\n", "B"]
    given = ["http://" + "".join(draw.choice(parts) for _ in range(draw.randrange(14))) for _ in range(1500)]
    given += ["".join(draw.choice(parts) for _ in range(9)) for _ in range(300)]
    given += [f"http://{'a.' * draw.randrange(3)}b.com/x/{'y' * draw.randrange(7)}" for _ in range(50)]
    filters = urls.UrlFilter([r for r in filters.rules if r[0]], filters.strict, filters.soft, 2)
    rows = judge(spark, given, filters)
    for url, r in zip(given, rows):
        assert (r.host, r.path, r.rule, r.verdict, r.strict_terms, r.soft_terms) == brute(url, filters), url
    assert {r.verdict for r in rows} == {"allow", "block"} and len({r.rule for r in rows}) == 5


def test_arguments():
    for bad in ({"rules": [("a", "/", "deny")]}, {"rules": [("a", "/", "allow"), ("a", "/", "block")]}, {"soft": ("xxx",)}, {"soft": ("",)}):
        with pytest.raises(ValueError):
            urls.UrlFilter(**bad)
    assert urls.UrlFilter(rules=(), strict=(), soft=()).judge()("u", "h", "/p") == (None, "allow", [], [], 0)


def test_odd_rows(spark, odd, no_docs):
    out = urls.filter_urls(odd.withColumnRenamed("score", "Host").withColumnRenamed("law", "weight"), url="text")
    assert out.count() == odd.count() and len(out.columns) == len(odd.columns) + 7
    assert out.columns[: len(odd.columns)] == [{"score": "Host", "law": "weight"}.get(c, c) for c in odd.columns]
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    assert urls.filter_urls(no_docs, url="text").count() == 0
    long = "http://x.net/" + "a/" * 200_000 + "casino"
    assert judge(spark, [long, long])[1].verdict == "block"
