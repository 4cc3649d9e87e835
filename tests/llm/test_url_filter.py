import re

import pytest

from kpiloom.llm.url_filter import RULES, SOFT, SOFT_LIMIT, STRICT, filter_urls, read_vocabulary

SCHEMA = "page_id long, url string, host string, rule string, n_soft string"


def brute(url):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url or "")
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in re.split(r"[/?#]", rest)[0])
        path = re.split(r"[?#]", rest[len(host):])[0]
    fits = [(h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda x: len(x[0])) if fits else (None, None)
    has = lambda t: re.search(f"(?<![a-z0-9]){t}(?![a-z0-9])", low)
    hard, mild = any(has(t) for t in STRICT), sum(w for t, w in SOFT.items() if has(t))
    return host, path, rule, verdict or ("block" if hard or mild >= SOFT_LIMIT else "allow")


def test_rules_and_terms_against_brute_force(spark):
    urls = [None, "", "no scheme/casino", "http://WWW.Example.ORG/es/1", "http://example.org/en/12?x", "http://a.example.org/en/2",
            "https://org/", "https://org", "http://x.com/fr/", "http://x.com/de/free-bets", "http://x.com/fr", "http://notcom/fr/",
            "http://xcom/fr/casino", "http://my-casino.net/a", "http://mycasino.net/", "http://free-bets.net/", "http://free.free.net/",
            "http://x.net/?q=cheap&p=pills#top", "http://x.net/cheap2/pills", "http://x.net:80/a?b=://c/d", "a://b://c/d", "http://ÉÀ.net/İx",
            "http://x.net/porno", "http://x.net/" + "a/" * 20_000 + "casino", "://host/p", "http:///path", "http://x.org\n/es/"]
    rows = [(i, u, "x", "y", "z") for i, u in enumerate(urls)] + [(1, "", "x", "y", "z"), (None, None, None, None, None)]
    out = filter_urls(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.host, r.path, r.rule, r.verdict) == brute(r.url), r.url
    assert filter_urls(spark.createDataFrame([], SCHEMA)).count() == 0


def test_weights_decide_and_no_soft_term_does_alone(spark):
    assert max(SOFT.values()) < SOFT_LIMIT and len(set(SOFT.values())) > 1
    urls = ["http://a.net/poker", "http://a.net/poker/free", "http://a.net/free/cheap", "http://a.net/free/cheap/win", "http://a.net/poker-slots"]
    out = {r.url: r.verdict for r in filter_urls(spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")).collect()}
    assert [out[u] for u in urls] == ["allow", "block", "allow", "block", "block"]


def test_vocabulary_from_a_table(spark):
    rows = [("Casino", None, "x"), ("casino", 2, "x"), ("bet", 1, "y"), ("BET", 3, "y"), ("", 1, "z"), (None, None, "z"), ("low", 0, "z"), ("é", 1, None)]
    terms = spark.createDataFrame(rows, "term string, weight int, strict string")
    strict, soft = read_vocabulary(terms)
    assert (strict, soft) == (("casino",), {"bet": 3, "é": 1})
    pages = spark.createDataFrame([(1, "http://a.net/CASINO"), (2, "http://a.net/bet"), (3, "http://a.net/porn")], "page_id long, url string")
    assert [r.verdict for r in filter_urls(pages, strict=strict, soft=soft, limit=3).orderBy("page_id").collect()] == ["block", "block", "allow"]
    assert read_vocabulary(terms.where("false")) == ((), {})
    with pytest.raises(ValueError):
        read_vocabulary(terms, most=2)


def test_no_terms_at_all(spark):
    pages = spark.createDataFrame([(1, "http://a.net/casino"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in filter_urls(pages, strict=(), soft={}).collect()} == {"allow"}
