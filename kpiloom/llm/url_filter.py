"""URL filters: host and path rules, then a weighted vocabulary.

Rules (host, path prefix) decide first; the longest one that fits wins.  For
the rest an Aho-Corasick automaton finds all vocabulary terms in the lower-cased
URL; a term counts only where it is not inside a longer run of letters or
digits.  One strict term, or distinct soft terms whose weights reach the limit,
block the URL.

Defined results: a null URL, or one without ``://``, has an empty host and path,
fits no rule and is judged by its terms (null: allowed); repeated rows are judged
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import mapped

# Rules (host with its subdomains, path prefix, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
# Vocabulary. One strict term blocks; soft terms add their weights.
STRICT = ("casino", "porn", "porno", "xxx", "viagra", "cialis", "escort", "escorts", "warez", "jackpot", "malware")
SOFT = {
    "bet": 2, "bets": 2, "betting": 2, "bonus": 1, "cheap": 1, "crack": 2, "dating": 2, "deal": 1, "deals": 1,
    "free": 1, "gratis": 1, "hot": 1, "loan": 1, "loans": 1, "lottery": 2, "nude": 2, "pill": 2, "pills": 2,
    "poker": 2, "prize": 1, "sex": 2, "sexy": 2, "slot": 2, "slots": 2, "torrent": 2, "win": 1, "winner": 1,
}
SOFT_LIMIT = 3          # above any single weight: two telling terms, or one and a common word, or three common words
MAX_TERMS = 100_000     # of a vocabulary read from a table
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_vocabulary(terms: DataFrame, most: int = MAX_TERMS) -> tuple[tuple[str, ...], dict[str, int]]:
    """(strict terms, soft terms with weights) of a table (term, weight); a null weight marks a strict term.

    Terms are lower-cased (A-Z); empty and null ones, and weights below 1, are
    left out; of repeated terms the strict one, else the greatest weight, holds.
    More than ``most`` terms raise, as every task holds them all.
    """
    term = F.translate(F.col("term"), UPPER, LOWER)
    rows = (terms.where("term <> '' AND (weight IS NULL OR weight >= 1)")
                 .groupBy(term.alias("term")).agg(F.max(F.col("weight").isNull()).alias("strict"), F.max("weight").cast("long").alias("weight"))
                 .limit(most + 1).collect())                                   # at most ``most`` + 1 rows
    if len(rows) > most:
        raise ValueError(f"a vocabulary has at most {most} terms")
    return tuple(sorted(r["term"] for r in rows if r["strict"])), {r["term"]: r["weight"] for r in sorted(rows) if not r["strict"]}


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; empty for null and where there is no ``://``."""
    url = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits; nulls if none does."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):     # later ones override
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def term_hits(urls: DataFrame, strict=STRICT, soft=SOFT) -> DataFrame:
    """Adds n_strict (occurrences), n_soft (distinct terms) and soft_weight to rows with a column ``url``."""
    def scan(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick
        found = ahocorasick.Automaton()
        hard_terms = frozenset(strict)
        for t in (*strict, *soft):
            found.add_word(t, (t, t in hard_terms))
        found.make_automaton()
        solid = set("abcdefghijklmnopqrstuvwxyz0123456789")
        fold = str.maketrans(UPPER, LOWER)
        for b in it:
            n_strict, n_soft, weight = [], [], []
            for url in b.column(b.schema.get_field_index("url")).to_pylist():
                hard, mild = 0, set()
                url = (url or "").translate(fold)
                for end, (term, is_strict) in found.iter(url) if len(found) else ():      # an automaton without words is none
                    start = end - len(term)
                    if (start >= 0 and url[start] in solid) or (end + 1 < len(url) and url[end + 1] in solid):
                        continue
                    if is_strict:
                        hard += 1
                    else:
                        mild.add(term)
                n_strict.append(hard)
                n_soft.append(len(mild))
                weight.append(sum(soft[t] for t in mild))
            for name, x in (("n_strict", n_strict), ("n_soft", n_soft), ("soft_weight", weight)):
                b = b.append_column(name, pa.array(x, pa.int64()))
            yield b
    schema = ", ".join(f"`{n}` {t}" for n, t in urls.dtypes) + ", n_strict long, n_soft long, soft_weight long"
    return mapped(urls, scan, schema)


def filter_urls(pages: DataFrame, rules=RULES, strict=STRICT, soft=SOFT, limit: int = SOFT_LIMIT) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, n_strict, n_soft, soft_weight) of every page."""
    hits = term_hits(pages.select("page_id", "url"), strict, soft)
    host, path = host_and_path(F.col("url"))
    rule, by_rule = longest_rule(F.col("host"), F.col("path"), rules)
    by_terms = F.when((F.col("n_strict") > 0) | (F.col("soft_weight") >= limit), "block").otherwise("allow")
    return (hits.withColumns({"host": host, "path": path})
                .withColumns({"rule": rule, "verdict": F.coalesce(by_rule, by_terms)}))
