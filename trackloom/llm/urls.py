"""URL filter: rules by host and path, and a weighted vocabulary for all other URLs.

A rule (host, path, verdict) fits its host and all its subdomains if the URL's path starts with the
rule's path. Of the rules that fit, the one whose host and path are longest together decides; ties
go to the longer host. Where none fits, an Aho-Corasick automaton reads the URL once and counts the
terms of a vocabulary. A term counts where no letter or digit stands before or behind it. A strict
term weighs as much as ``soft_hits`` soft terms; a URL whose different terms weigh that much
together is blocked: one strict term, or several different soft ones.

Defined results: a URL that is null or has no ``://`` has an empty host and an empty path, so no
rule fits; a null or empty URL is allowed; letters beyond A-Z are compared as they stand; a term
that stands twice counts once; URLs are read whole, whatever their length; repeated rows are judged
each; an empty table gives no row; other columns are carried along untouched.

Rules and terms are arguments of the driver and shipped with the function: lists, not tables.
"""

import string
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

#: terms of which one alone rejects a URL (fixed values)
STRICT_TERMS = (
    "adult", "casino", "escort", "hentai", "hookup", "jackpot", "keygen", "malware", "milf", "nude",
    "phishing", "poker", "porn", "porno", "sex", "slots", "spam", "torrent", "viagra", "warez",
    "webcam-girls", "xxx",
)
#: terms that reject a URL only together (fixed values)
SOFT_TERMS = (
    "ads", "affiliate", "banner", "bet", "bets", "bonus", "buy", "cheap", "click", "coupon", "crack",
    "dating", "deal", "deals", "discount", "farm", "free", "gambling", "hot", "lottery", "loan",
    "meds", "money", "offer", "pharmacy", "pill", "pills", "popup", "prize", "replica", "rx", "serial",
    "sexy", "singles", "track", "tracker", "win", "winner",
)
#: (host, path, verdict)
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
SOFT_HITS = 2
_RESULT = "rule string, verdict string, strict_terms array<string>, soft_terms array<string>, weight int"
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


@dataclass(frozen=True)
class UrlFilter:
    """Rules and vocabulary; terms are lower case."""

    rules: Sequence[tuple[str, str, str]] = RULES
    strict: Sequence[str] = STRICT_TERMS
    soft: Sequence[str] = SOFT_TERMS
    soft_hits: int = SOFT_HITS

    def __post_init__(self):
        if any(v not in ("allow", "block") for _, _, v in self.rules):
            raise ValueError("a rule allows or blocks")
        if len({(h, p) for h, p, _ in self.rules}) < len(self.rules):
            raise ValueError("two rules have the same host and path")
        if set(self.strict) & set(self.soft) or not all([*self.strict, *self.soft]):
            raise ValueError("a term is strict or soft, and not empty")

    def judge(self):
        """A function (url, host, path) -> (rule, verdict, strict terms, soft terms, weight)."""
        automaton = ahocorasick.Automaton()
        for weight, terms in ((self.soft_hits, self.strict), (1, self.soft)):
            for term in terms:
                automaton.add_word(term, (term, weight))
        if len(automaton):
            automaton.make_automaton()
        paths: dict[str, dict[str, str]] = {}
        for host, path, verdict in self.rules:
            paths.setdefault(host, {})[path] = verdict
        lengths = {host: sorted({len(p) for p in own}, reverse=True) for host, own in paths.items()}

        def rule_of(host: str, path: str) -> tuple[str, str] | None:
            best, size = None, (-1, -1)
            while host:
                if host in paths:
                    for n in lengths[host]:
                        if n <= len(path) and path[:n] in paths[host]:
                            if (len(host) + n, len(host)) > size:
                                best, size = (host + path[:n], paths[host][path[:n]]), (len(host) + n, len(host))
                            break
                host = host.partition(".")[2]
            return best

        def terms_of(url: str) -> dict[str, int]:
            seen: dict[str, int] = {}
            for last, (term, weight) in automaton.iter(url) if len(automaton) else ():
                first = last - len(term) + 1
                if not (first and url[first - 1].isalnum()) and not url[last + 1 : last + 2].isalnum():
                    seen[term] = weight
            return seen

        def judged(url: str | None, host: str, path: str):
            seen = terms_of(url.translate(_LOWER)) if url else {}
            weight = sum(seen.values())
            strict, soft = (sorted(t for t in seen if t in kind) for kind in (self.strict, self.soft))
            rule = rule_of(host, path)
            verdict = rule[1] if rule else "block" if weight >= self.soft_hits else "allow"
            return rule and rule[0], verdict, strict, soft, weight

        return judged


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Behind the first ``://``: up to ``/``, ``?`` or ``#``; and from there up to ``?`` or ``#``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit(""))
    behind = F.substring(rest, F.length(host) + 1, F.length(url))
    path = F.coalesce(F.regexp_extract(behind, r"^[^?#]*", 0), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def verdicts(url: Column, host: Column, path: Column, given: UrlFilter) -> Column:
    """A struct: rule, verdict, strict and soft terms, weight."""

    @F.pandas_udf(_RESULT)
    def judged(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        judge = given.judge()
        names = [c.split()[0] for c in _RESULT.split(", ")]
        for urls, hosts, paths in parts:
            rows: Iterable = (judge(u if isinstance(u, str) else None, h, p) for u, h, p in zip(urls, hosts, paths))
            yield pd.DataFrame(list(rows), columns=names)

    return judged(url, host, path)


def filter_urls(pages: DataFrame, url: str = "url", given: UrlFilter = UrlFilter()) -> DataFrame:
    """``pages`` with host, path, rule, verdict, strict_terms, soft_terms and weight.

    A result whose name a column has already gets a suffix; the last seven columns are the results.
    """
    own = {n: fresh(pages, n) for n in ("host", "path", "rule", "verdict", "strict_terms", "soft_terms", "weight")}
    judged = fresh(pages, "judged")
    host, path = host_and_path(F.col(url))
    found = pages.withColumns({own["host"]: host, own["path"]: path}).withColumn(
        judged, verdicts(F.col(url), F.col(own["host"]), F.col(own["path"]), given)
    )
    return found.select(
        *pages.columns, own["host"], own["path"],
        *[F.col(judged)[n].alias(name) for n, name in own.items() if n not in ("host", "path")],
    )
