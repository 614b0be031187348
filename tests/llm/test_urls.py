"""URL filters: rules and link-graph scores against a plain reading."""

import random
import re

import pytest

from pitchside.llm import registry, urls

SF = "/root/testdata/sf0.01"


def plain(pages, rules, damping=0.85, threshold=1.0):
    def split(url):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")

    def rule(h, p):
        fit = [r for r in rules if (h == r[1] or h.endswith("." + r[1])) and p.startswith(r[2])]
        return max(fit, key=lambda r: (len(r[1] + r[2]), r[0] == "block"), default=None)

    rows = [(i, *split(u), x) for i, u, x in pages]
    per, links = {}, {}
    for _, h, p, html in rows:
        if h:
            r = rule(h, p)
            v = per.setdefault(h, [0, 0, 0])
            v[0] += 1
            v[1] += bool(r and r[0] == "allow")
            v[2] += bool(r and r[0] == "block")
            for t in set(re.findall(r'href="https?://([^/"]+)', html or "")) - {h}:
                links[h, t] = links.get((h, t), 0) + 1
    scores = []
    for side, ways in ((0, links), (1, {(b, a): n for (a, b), n in links.items()})):
        seeds = [h for h, (n, a, b) in per.items() if 2 * (a + b) >= n and (a > b if side == 0 else b > a)]
        out = {}
        for (f, _), n in ways.items():
            out[f] = out.get(f, 0) + n
        start = {h: 1 / len(seeds) for h in seeds}
        now = dict(start)
        for _ in range(200):
            new = {h: (1 - damping) * s for h, s in start.items()}
            for (f, t), n in ways.items():
                new[t] = new.get(t, 0) + damping * now.get(f, 0) * n / out[f]
            now = new
        scores.append(now)
    got = {}
    for i, h, p, _ in rows:
        r = rule(h, p)
        d, t = scores[1].get(h, 0), scores[0].get(h, 0)
        got[i] = (h, p, r and r[1] + r[2], r[0] if r else "block" if d > 0 and d >= threshold * t else "allow")
    return got


@pytest.mark.parametrize("seed", [1])
def test_brute_force(spark, seed):
    rng = random.Random(seed)
    hosts = [f"h{i}.{d}" for i in range(12) for d in ("example.com", "example.net", "a.org", "example.org", "net")]
    pages = [(i, f"http://{rng.choice(hosts)}/{rng.choice(['en', 'de', 'fr'])}/{i}?x#y",
              "".join(f'<a href="https://{rng.choice(hosts)}/q">' for _ in range(rng.randrange(4)))) for i in range(300)]
    pages += [(1000, None, "x"), (1001, "no scheme", None), (1002, "HTTP://A.Net", None), (1003, "http://B.ORG/fr/?q", "<a href=//x.y/>"),
              (1004, "x://h#f/", ""), (1004, "x://h#f/", ""), (1005, "http://" + "a." * 20000 + "org/fr/", "<a href='" * 9000)]
    df = spark.createDataFrame([(*p, "c") for p in pages], "page_id long, url string, html string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge_urls(df, tolerance=1e-4, max_steps=60).collect()}
    want = plain(pages, urls.RULES)
    assert got == want
    assert {v[3] for v in got.values() if v[2] is None} == {"allow", "block"}


def test_empty_and_query(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.judge_urls(df).count() == 0
    rows = registry.QUERIES["op10_url_filter"](spark, SF).collect()
    pages = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert {r["page_id"]: tuple(r)[1:] for r in rows} == plain(pages, urls.RULES)


def test_scores_reach_hosts_far_from_a_seed(spark):
    """A ring without leaks: distrust of the one seed reaches the host 55 links behind it."""
    n = 56
    pages = [(0, "http://h0.net/", '<a href="http://h1.com/">')]
    pages += [(i, f"http://h{i}.com/", f'<a href="http://h{(i + 1) % n}.{"com" if (i + 1) % n else "net"}/">') for i in range(1, n)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge_urls(df).collect()}
    assert got == plain(pages, urls.RULES) and {v[3] for v in got.values()} == {"block"}


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "http://a.net/x", "", 5, "s", "r")], "page_id long, url string, html string, _host int, _salt string, _rule string")
    out = urls.judge_urls(df)
    assert out.columns == [*df.columns, "host", "path", "rule", "verdict"]
    assert tuple(out.first()) == (1, "http://a.net/x", "", 5, "s", "r", "a.net", "/x", "net/", "block")
