import math
import re
from collections import Counter

import pytest

from conftest import SF_SMALL
from harness import compare
from llm_fixtures import some_labels  # noqa: F401
from tessera.llm import queries, url_reputation as U


def _parsed(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c.group().lower(), m[1]), m[2]) if m else ("", "")


def _rule(host, path):
    fits = [(h + p, a) for a, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0]), default=(None, None))


URLS = [
    (1, "http://A.Example.NET/en/x?y#z"), (2, "https://net/"), (3, "https://net"), (4, "ftp://x.org/fr/"), (5, "x.org/fr/"), (6, None), (7, ""),
    (8, "http://example.com/de/#a://b"), (9, "http://notexample.com/de/"), (10, "http://example.net/de/"), (11, "http://É.org?q=/fr/"),
    (12, "://"), (13, "a://b.co.uk/p\nq"), (13, "a://b.co.uk/p\nq"), (None, "http://spam.example.com/"), (14, "http://x://y.net/"),
]


def test_parts_and_rules(spark, some_labels):
    pages = spark.createDataFrame([(i, u, 1, "q") for i, u in URLS], "page_id long, url string, n int, domain string")
    rows = U.judge(pages, some_labels).collect()
    expected = Counter()
    for i, u in URLS:
        h, p = _parsed(u)
        expected[(i, h, p, _rule(h, p)[0])] += 1
    assert Counter((r["page_id"], r["host"], r["path"], r["rule"]) for r in rows) == expected
    assert all(r["verdict"] == _rule(r["host"], r["path"])[1] for r in rows if r["rule"])
    assert U.judge(pages, some_labels.limit(0)).filter("rule is null and verdict <> 'allow'").count() == 0
    assert U.judge(pages.limit(0), some_labels).count() == 0


def _shrink(units, k):
    return {u: (b + k * m) / (n + k) for u, (n, b, m) in units.items()}


def _weight(units):
    units = [x for x in units.values() if x[0]]
    v, wv = sum(m * (1 - m) for _, _, m in units), sum(n * m * (1 - m) for n, _, m in units)
    if wv == v:
        return U.K_RANGE[1]
    rho = (sum((b - n * m) ** 2 / n for n, b, m in units) - v) / (wv - v)
    return U.K_RANGE[1] if rho <= 0 else min(max(1 / rho - 1, U.K_RANGE[0]), U.K_RANGE[1])


def test_reputation_matches_plain_version(spark):
    """Bad hosts below a good domain, and hosts without labels."""
    rows, labels, i = [], [], 0
    for host, n, bad in [("spam.good.com", 40, 38), ("www.good.com", 60, 1), ("new.good.com", 2, 0), ("a.evil.org", 20, 19), ("b.evil.org", 15, 15),
                         ("c.evil.org", 0, 0), ("x.co.uk", 5, 0), ("y.co.uk", 1, 1)]:
        for k in range(max(n, 1)):
            rows.append((i, f"http://{host}/{k}"))
            if n:
                labels.append((i, int(k >= bad), 0))
            i += 1
    pages, marks = spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["host"]: r for r in U.reputation(pages, marks).collect()}
    hosts = {h: (r["n"], r["bad"]) for h, r in got.items()}

    def up(key):
        out = Counter(), Counter()
        for h, (n, b) in hosts.items():
            out[0][key(h)] += n
            out[1][key(h)] += b
        return out

    two = lambda h: ".".join(h.split(".")[-2:])
    domain = lambda h: h if two(h) == "co.uk" else two(h)
    suffix = lambda h: two(h) if two(h) == "co.uk" else h.split(".")[-1]
    n_all, b_all = sum(n for n, _ in hosts.values()), sum(b for _, b in hosts.values())
    n, b = up(suffix)
    units = {s: (n[s], b[s], (b_all + 1) / (n_all + 2)) for s in n}
    s_mean = _shrink(units, _weight(units))
    n, b = up(domain)
    units = {d: (n[d], b[d], s_mean[suffix(d)]) for d in n}
    d_mean = _shrink(units, _weight(units))
    units = {h: (*hosts[h], d_mean[domain(h)]) for h in hosts}
    k = _weight(units)
    for h, mean in _shrink(units, k).items():
        assert got[h]["mean"] == pytest.approx(mean)
        assert got[h]["bound"] == pytest.approx(mean - U.Z * math.sqrt(mean * (1 - mean) / (hosts[h][0] + k + 1)))
    verdicts = {r["host"]: r["verdict"] for r in U.judge(pages, marks, rules=()).collect()}
    assert verdicts["spam.good.com"] == verdicts["a.evil.org"] == "block"
    assert verdicts["www.good.com"] == verdicts["new.good.com"] == verdicts["x.co.uk"] == "allow"


def test_query_matches_sql(spark):
    ok, _, _, detail = compare(spark, "op9", queries.op9_url_reputation, queries.oracle_sql()["op9_url_reputation"], SF_SMALL)
    assert ok, detail


def test_suffixes_from_a_table(spark):
    listed = spark.createDataFrame([("com",), ("co.uk",), ("uk",), ("gov.uk",), (" City.Kawasaki.JP ",), ("",), (None,)], "suffix string")
    hosts = spark.createDataFrame([(h,) for h in ("a.b.co.uk", "co.uk", "x.gov.uk:8080", "www.x.com:80", "q.z.city.kawasaki.jp", "odd", "", "a.b.nowhere")], "host string")
    got = {r["host"]: (r["domain"], r["suffix"]) for r in U.with_domains(hosts, listed).collect()}
    assert got == {
        "a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.gov.uk:8080": ("x.gov.uk", "gov.uk"), "www.x.com:80": ("x.com", "com"),
        "q.z.city.kawasaki.jp": ("z.city.kawasaki.jp", "city.kawasaki.jp"), "odd": ("odd", "odd"), "": ("", ""), "a.b.nowhere": ("b.nowhere", "nowhere")}
    short = {r["host"]: (r["domain"], r["suffix"]) for r in U.with_domains(hosts).collect()}
    assert short["a.b.co.uk"] == ("b.co.uk", "co.uk") and short["www.x.com:80"] == ("x.com", "com")


def test_unlisted_neighbours_share_no_reputation(spark):
    """Pages of one site under a listed suffix are bad; another site there stays."""
    pages = spark.createDataFrame([(i, f"http://bad.gov.uk/{i}") for i in range(40)] + [(100, "http://good.gov.uk/"), (101, "http://other.net2/")], "page_id long, url string")
    labels = spark.createDataFrame([(i, 0, 0) for i in range(40)] + [(101, 1, 0)], "doc_id long, quality int, toxic int")
    listed = spark.createDataFrame([("gov.uk",), ("net2",)], "suffix string")
    bound = {r["page_id"]: r["bound"] for r in U.judge(pages, labels, (), suffixes=listed).collect()}
    merged = {r["page_id"]: r["bound"] for r in U.judge(pages, labels, ()).collect()}
    assert bound[100] < merged[100] and bound[0] > 0.5
