from __future__ import annotations

import math
from collections import defaultdict

import pytest

from riskpanel.llm.url_reputation import RULES, ReputationConfig, judge_urls
from tests.llm import brute
from tests.llm.frames import SMALL, labels_of, rows_of

SCHEMA = "page_id bigint, url string, html string, host string, seen string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "<p>", "clash", "clash") for r in rows], SCHEMA)


def rule_for(host: str, path: str):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def plain(pages: list[tuple], outcomes: dict, config: ReputationConfig = ReputationConfig()) -> dict:
    """host: (seen, mean, bound), level by level over dictionaries."""
    bad, seen = defaultdict(int), defaultdict(int)
    for page_id, url in pages:
        host = brute.url_parts(url)[0]
        bad[host] += outcomes.get(page_id) == 0
        seen[host] += page_id in outcomes

    def levels(host):
        bare = host.rsplit(":", 1)[0] if host.rsplit(":", 1)[-1].isdigit() or host.endswith(":") else host
        return ".".join(bare.split(".")[-2:]), bare.split(".")[-1]

    def grouped(key):
        out = defaultdict(lambda: [0, 0])
        for h in seen:
            out[key(h)][0] += bad[h]
            out[key(h)][1] += seen[h]
        return out

    def posterior(groups, prior, support):
        chance = sum(prior[g] * (1 - prior[g]) for g, (_, n) in groups.items() if n)
        spread = sum(n * (b / n - prior[g]) ** 2 for g, (b, n) in groups.items() if n)
        room = sum((n - 1) * prior[g] * (1 - prior[g]) for g, (_, n) in groups.items() if n)
        size = config.most if not room or spread <= chance else min(config.most, max(config.least, room / (spread - chance) - 1))
        held = {g: min(size, support[g]) for g in groups}
        return {g: (b + held[g] * prior[g], n - b + held[g] * (1 - prior[g])) for g, (b, n) in groups.items()}

    overall = (sum(bad.values()) + 1) / (sum(seen.values()) + 2)
    suffixes = grouped(lambda h: levels(h)[1])
    top = posterior(suffixes, dict.fromkeys(suffixes, overall), dict.fromkeys(suffixes, sum(seen.values()) + 2))
    rate = lambda ab: ab[0] / sum(ab)
    domains = grouped(levels)
    middle = posterior(domains, {d: rate(top[d[1]]) for d in domains}, {d: sum(top[d[1]]) for d in domains})
    hosts = {h: (bad[h], seen[h]) for h in seen}
    out = {}
    above = {h: middle[levels(h)] for h in hosts}
    for h, (a, b) in posterior(hosts, {h: rate(above[h]) for h in hosts}, {h: sum(above[h]) for h in hosts}).items():
        n = a + b
        out[h] = (seen[h], a / n, a / n - config.deviations * math.sqrt(a * b / (n * n * (n + 1))))
    return out


def check(got, pages, outcomes, config=ReputationConfig()):
    expected = plain(pages, outcomes, config)
    urls = dict(pages)
    for r in got:
        host, path = brute.url_parts(urls[r.page_id])
        rule = rule_for(host, path)
        seen, mean, bound = expected[host]
        assert (r.host, r.path, r.rule) == (host, path, rule.text if rule else None)
        assert (r.seen, r["mean"], r.bound) == (seen, pytest.approx(mean), pytest.approx(bound))
        assert r.verdict == (rule.verdict if rule else "block" if bound > config.limit else "allow")


def test_smallest_tables(spark):
    pages = rows_of(SMALL, "SELECT page_id, url FROM pages")
    outcomes = dict(rows_of(SMALL, "SELECT doc_id, quality FROM labels"))
    got = judge_urls(spark.read.parquet(f"{SMALL}/pages.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")).collect()
    assert len(got) == len(pages)
    check(got, pages, outcomes)


def test_bad_hosts_are_blocked_and_new_hosts_follow_their_domain(spark):
    pages = [(i, f"http://h{i % 5}.bad.net/x") for i in range(200)] + [(i, f"http://h{i % 5}.good.net/x") for i in range(200, 600)]
    pages += [(600, "http://new.bad.net/"), (601, "http://new.good.net/"), (602, "http://one.other.net/")]
    outcomes = {i: int(i >= 200) for i in range(600)} | {602: 0}
    got = judge_urls(frame(spark, pages), labels_of(spark, list(outcomes.items()))).collect()
    check(got, pages, outcomes)
    verdict = {r.page_id: r.verdict for r in got}
    assert verdict[0] == "block" and verdict[600] == "block" and verdict[300] == "allow" and verdict[601] == "allow"
    assert verdict[602] == "allow"  # one bad page proves nothing


URLS = [
    None, "", "no mark", "http://", "http:///p", "HTTP://ExAmple.ORG/es/1?q#f", "http://a.example.org/en/12", "http://example.org/en/2",
    "http://xexample.org/es/", "http://org", "http://org/", "https://É.Com/fr/x", "http://a.com:80/de/", "http://b.com?/de/", "x://y://z/a",
    "http://u@c.de/#?", "http://line\nbreak.com/fr/\n", "http://a.com/DE/", "http://com/de/", "http://" + "a." * 500 + "net/" + "p" * 5000,
]


def test_urls_of_all_kinds(spark):
    pages = list(enumerate(URLS))
    outcomes = {0: 0, 5: 1, 7: 0}
    labels = labels_of(spark, [(0, 0), (5, 1), (7, 1), (7, 0), (None, 0), (9, None), (999, 0)])
    got = judge_urls(frame(spark, pages), labels).collect()
    assert len(got) == len(URLS)
    check(got, pages, outcomes)


def test_repeated_pages_null_ids_and_empty_tables(spark):
    pages = [(1, "http://a.b/"), (1, "http://a.b/"), (None, "http://a.b/"), (None, None)]
    got = judge_urls(frame(spark, pages), labels_of(spark, [(1, 0), (None, 0)])).collect()
    assert len(got) == 4 and {r.seen for r in got if r.host} == {2}
    assert judge_urls(frame(spark, []), labels_of(spark, [(1, 0)])).count() == 0
    even = judge_urls(frame(spark, pages), labels_of(spark, [])).collect()
    assert {round(r["mean"], 6) for r in even} == {0.5}
