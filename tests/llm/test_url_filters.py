"""URL rules against their definition, and mined rules against all combinations of tokens."""

from __future__ import annotations

import itertools
import math
import random
import re
from collections import defaultdict

import pytest

from shelfpulse.llm import skew, url_filters
from shelfpulse.llm.common import Scratch
from shelfpulse.llm.queries import QUERIES

SPLIT = re.compile("[-./_:@%=&+,;~!]+")
LOWER = str.maketrans(url_filters._UPPER, url_filters._LOWER)


def parts(url):
    before, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = re.match("[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match("[^?#]*", rest[len(host) :])[0]


def fixed(host, path, rules=url_filters.RULES):
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def tokens(host, path):
    return {f"{mark}:{w.translate(LOWER)}" for mark, text in (("host", host), ("path", path)) for w in SPLIT.split(text) if w}


def verdicts(urls, support=url_filters.MIN_SUPPORT, confidence=url_filters.MIN_CONFIDENCE, most=url_filters.MAX_MINED_TOKENS):
    """Brute force: counts every combination of kept tokens in every URL of known verdict."""
    split = [parts(u) for u in urls]
    known = [fixed(*s) for s in split]
    sets = [tokens(*s) for s in split]
    taught = [(t, v) for t, (_, v) in zip(sets, known, strict=True) if v]
    total, blocked = len(taught), sum(v == "block" for _, v in taught)
    least = max(url_filters.MIN_URLS, math.ceil(support * total))
    where = defaultdict(set)
    for i, (own, _) in enumerate(taught):
        for t in own:
            where[t].add(i)
    classes = {}
    for t in sorted(where):
        if least <= len(where[t]) < total:
            classes.setdefault(frozenset(where[t]), t)
    tells = {t: abs(sum(taught[i][1] == "block" for i in at) / len(at) - blocked / total) for at, t in classes.items()}
    n = {t: len(at) for at, t in classes.items()}
    fits, holds = defaultdict(int), defaultdict(int)
    for own, verdict in taught:
        kept = sorted((-tells[t], t) for t in own if t in tells)[:most]
        kept = sorted(t for _, t in kept)
        for size in range(1, len(kept) + 1):
            for combination in itertools.combinations(kept, size):
                fits[combination] += 1
                holds[combination, verdict] += 1
    rules = {k: (holds[k] / fits[k[0]], holds[k]) for k in holds if holds[k] >= least and holds[k] / fits[k[0]] >= confidence}
    idle = {
        (c, v) for (c, v), (sure, _) in rules.items()
        for t in c if rules.get((tuple(x for x in c if x != t), v), (0,))[0] >= sure
    }
    rules = {k: v for k, v in rules.items() if k not in idle}
    assert all(min((n[t], t) for t in c) for c, _ in rules)
    found = []
    for own, (rule, verdict) in zip(sets, known, strict=True):
        best = min(((-c, -s, len(k), k, v) for (k, v), (c, s) in rules.items() if own.issuperset(k)), default=[None])
        found.append((rule, verdict or best[-1] or "allow"))
    return [(*s, *f) for s, f in zip(split, found, strict=True)], rules


def made_up(seed):
    rng = random.Random(seed)
    hosts = ["shop-one.example.com", "www.example.com", "a.b.example.net", "pills.example.net", "news.example.org", "EXAMPLE.com"]
    return [
        f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}/{rng.choice(['en', 'fr', 'es', 'de'])}/"
        f"{rng.choice(['item', 'cheap-pills', 'news/today'])}/{rng.randint(0, 30)}{rng.choice(['', '?q=1', '#top', '.html'])}"
        for _ in range(400)
    ]


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(skew, "LEAST", 20)
    urls = made_up(seed) + ["http://same.example.net/fr/one/two/three"] * 150  # a URL of a third of all
    want, rules = verdicts(urls)
    assert len(rules) > 5 and {w[3] for w in want if w[2] is None} == {"allow", "block"}
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    found = {r.page_id: tuple(r)[1:] for r in url_filters.judge(pages, Scratch(spark)).collect()}
    assert [found[i] for i in range(len(urls))] == want


def all_rules(rows):
    """Brute force: every rule of rows of tokens and verdict that no token less makes idle."""
    total = len(rows)
    least = max(url_filters.MIN_URLS, math.ceil(url_filters.MIN_SUPPORT * total))
    where = defaultdict(set)
    for i, (own, _) in enumerate(rows):
        for t in own:
            where[t].add(i)
    classes = {}
    for t in sorted(where):
        if least <= len(where[t]) < total:
            classes.setdefault(frozenset(where[t]), t)
    kept, rules = set(classes.values()), {}
    for own in {frozenset(own) & kept for own, _ in rows}:
        for size in range(1, len(own) + 1):
            for c in itertools.combinations(sorted(own), size):
                at = frozenset.intersection(*(frozenset(where[t]) for t in c))
                for v in url_filters.VERDICTS:
                    right = sum(rows[i][1] == v for i in at)
                    if right >= least and right / len(at) >= url_filters.MIN_CONFIDENCE:
                        rules[c, v] = (right / len(at), right)
    return {
        (c, v): found for (c, v), found in rules.items()
        if all(rules.get((tuple(x for x in c if x != t), v), (0,))[0] < found[0] for t in c)
    }


def mined(spark, rows, **limits):
    labelled = spark.createDataFrame([(sorted(own), v) for own, v in rows], "tokens array<string>, verdict string")
    return {(tuple(r.tokens), r.verdict): (r.confidence, r.support) for r in url_filters.mine(labelled, Scratch(spark), **limits).collect()}


def wide_rows(seed):
    """URLs with 16 tokens in common use, of which only a pair tells the verdict."""
    rng = random.Random(seed)
    rows = []
    for _ in range(60):
        own = {f"t{i:02}" for i in range(14) if rng.random() < 0.25}
        a, b = rng.random() < 0.5, rng.random() < 0.5
        verdict = "block" if a == b and rng.random() < 0.95 else "allow"
        rows.append((own | ({"xa"} if a else {"ya"}) | ({"xb"} if b else {"yb"}), verdict))
    common = {f"t{i:02}" for i in range(14)}
    return rows + [(common | {"xa", "xb"}, "block")] * 3 + [(common | {"ya", "xb"}, "allow")] * 3


def test_long_urls_are_mined_with_all_their_tokens(spark, monkeypatch):
    monkeypatch.setattr(skew, "LEAST", 20)
    rows = wide_rows(3)
    want = all_rules(rows)
    assert max(len(c) for c, _ in want) > 2 and (("xa", "xb"), "block") in want
    assert mined(spark, rows) == want


def test_both_ways_of_mining_find_the_same_rules(spark):
    split = [parts(u) for u in made_up(5)]
    rows = [(tokens(*s), fixed(*s)[1] or ("block" if len(s[1]) % 3 else "allow")) for s in split]
    found = mined(spark, rows)
    assert len(found) > 5 and found == mined(spark, rows, max_tokens=0)


def test_many_subsets_of_a_long_url_are_not_listed(spark):
    """2 ** 40 subsets are in ten URLs; all but the pairs add nothing to a smaller one."""
    every = {f"t{i}" for i in range(40)}
    rows = [(every, "block")] * 8 + [(every, "allow")] * 2
    rows += [({f"t{i}"}, v) for i in range(40) for v in ("allow",) * 3 + ("block",) * 2]
    found = mined(spark, rows)
    assert len(found) == 40 * 39 // 2 and set(found.values()) == {(0.8, 8)} and {len(c) for c, _ in found} == {2}


def test_query_equals_brute_force(spark, duck, sf_dir):
    pages = duck.execute("SELECT page_id, url FROM pages").fetchall()
    want, _ = verdicts([u for _, u in pages])
    found = QUERIES["op12_url_filters"](spark, sf_dir)
    assert "Python" not in found._jdf.queryExecution().toString()
    assert sorted(map(tuple, found.collect()), key=str) == sorted(((p, *w) for (p, _), w in zip(pages, want, strict=True)), key=str)


def test_longest_rule_wins(spark):
    urls = {
        "http://com/": ("com", "/", "com/", "allow"),
        "http://com": ("com", "", None, "allow"),
        "x://WWW.Example.COM/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "x://a.www.example.com/en/1?x": ("a.www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "x://wwww.example.com/en/1": ("wwww.example.com", "/en/1", "example.com/en/", "block"),
        "x://badexample.com/en/1": ("badexample.com", "/en/1", "com/", "allow"),
        "x://example.com/EN/1": ("example.com", "/EN/1", "com/", "allow"),
        "x://a.net/es/a/b#/c": ("a.net", "/es/a/b", "net/es/", "block"),
        "x://É.net:80/fr/": ("É.net:80", "/fr/", None, "allow"),
        "mailto:a@b.net": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "a://b://c.net/es/": ("b:", "//c.net/es/", None, "allow"),
        "://net/es/\nx": ("net", "/es/\nx", "net/es/", "block"),
        "x://a.net?/es/": ("a.net", "", None, "allow"),
    }
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    found = {r.page_id: tuple(r)[1:] for r in url_filters.judge(pages, Scratch(spark)).collect()}
    assert found == dict(enumerate(urls.values()))


def test_awkward_rows(spark):
    long = "http://x.example.net/fr/" + "/".join(f"s{i}" for i in range(60_000))
    rows = [(1, None), (None, "http://a.com/x"), (2, long), (2, long), (3, "http://a.org/"), (3, "http://a.org/")] + [(9, long)] * 8
    pages = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "page_id bigint, url string, rule string, host string, _url_row int")
    found = sorted((r.page_id or 0, r.host, r.rule, r.verdict) for r in url_filters.judge(pages, Scratch(spark)).collect() if r.rule)
    assert found == [(0, "a.com", "com/", "allow")] + [(2, "x.example.net", "net/fr/", "block")] * 2 + [(9, "x.example.net", "net/fr/", "block")] * 8
    assert url_filters.judge(pages.limit(0), Scratch(spark)).count() == 0
