"""URL filters against plain Python."""

import math
import re
from collections import Counter, defaultdict

import xxhash

from riskweave.llm import queries, urls
from tests.conftest import SF_SMALL


def parts(url):
    if not url or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]


def rule_of(host, path):
    fit = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.text)) if fit else None


def slow(all_urls):
    """{url: (host, path, rule, verdict)} by models counted in dictionaries."""
    texts = {}
    for u in all_urls:
        host, path = parts(u)
        s = (host + path).lower() if u and "://" in u else (u or "").lower()
        allowed, blocked = texts.setdefault(s, [False, False])
        r = rule_of(host, path)
        texts[s] = [allowed or bool(r and r.verdict == "allow"), blocked or bool(r and r.verdict == "block")]
    counts = [defaultdict(Counter), defaultdict(Counter)]

    def grams(s):
        padded = urls.START * urls.ORDER + s + urls.END
        return [padded[i:i + urls.ORDER + 1] for i in range(len(padded) - urls.ORDER)]

    def held(s):
        return xxhash.xxh64_intdigest(s.encode(), 42) % urls.HELD_OUT == 0

    for s, flags in texts.items():
        for side, on in enumerate(flags):
            for g in grams(s) if on and not held(s) else ():
                for k in range(urls.ORDER + 1):
                    counts[side][g[urls.ORDER - k:-1]][g[-1]] += 1

    def ratio(g):
        logs = []
        for side in counts:
            p = 1 / urls.ALPHABET
            for k in range(urls.ORDER + 1):
                c = side.get(g[urls.ORDER - k:-1])
                if c:
                    p = (c[g[-1]] + len(c) * p) / (sum(c.values()) + len(c))
            logs.append(math.log(p))
        return round((logs[0] - logs[1]) * urls.UNIT)

    scores = {s: sum(map(ratio, grams(s))) / len(grams(s)) / urls.UNIT for s in texts}
    buckets = defaultdict(lambda: [0, 0])
    own = [s for s in texts if held(s)]
    own = own if all(any(texts[s][side] for s in own) for side in (0, 1)) else list(texts)
    for s in own:
        for side in (0, 1):
            buckets[math.floor(scores[s] * urls.UNIT / urls.BUCKET)][side] += texts[s][side]
    limit = urls.threshold([(k, *v) for k, v in buckets.items() if any(v)])
    out = {}
    for u in all_urls:
        host, path = parts(u)
        r = rule_of(host, path)
        s = (host + path).lower() if u and "://" in u else (u or "").lower()
        out[u] = (host, path, r.text if r else None, r.verdict if r else "block" if scores[s] < limit else "allow")
    return out


def test_rules_and_parts(spark):
    given = [None, "", "no scheme.net/", "http://A.Example.NET/EN/x", "https://x.example.net/en/1?q#f", "https://net/", "https://net",
             "https://planet/", "http://example.com/de/", "http://example.com/deep", "ftp://x.org/fr/?a", "http://x.org?/fr/",
             "http://y.org#/fr/", "a://b://c.net/x", "http://é.example.org/ü/" + "x" * 3000, "http://x.org/fr/2", "http://x.org/fr/2"]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(given)] + [(None, given[3], "x")], "page_id int, url string, host string")
    want = slow(given)
    got = urls.judge(df).collect()
    assert len(got) == len(given) + 1
    for r in got:
        assert (r.host, r.path, r["rule"], r.verdict) == want[given[3 if r.page_id is None else r.page_id]], given[r.page_id or 3]
    assert urls.judge(df.limit(0)).count() == 0
    alone = urls.judge(spark.createDataFrame([(1, "http://x.example.com/")], "page_id int, url string")).first()
    assert alone.verdict == "allow"


def test_query(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    want = slow(list(pages.values()))
    got = queries.op7_urls(spark, SF_SMALL).collect()
    assert len(got) == len(pages)
    assert all((r.host, r.path, r["rule"], r.verdict) == want[pages[r.page_id]] for r in got)


def test_very_long_url(spark):
    given = ["http://x.net/" + "a/b?" * 3, "http://y.org/fr/" + "c" * 50, "http://long.example/" + "d/e" * 10_000, "http://long.example/" + "d/e" * 10_000]
    got = urls.judge(spark.createDataFrame([(i, u) for i, u in enumerate(given)], "page_id int, url string")).collect()
    want = slow(given)
    assert all((r.host, r.path, r["rule"], r.verdict) == want[given[r.page_id]] for r in got) and len(got) == 4


def test_threshold_comes_from_held_urls():
    rows = [(10, False, 50, 0), (-10, False, 0, 50), (4, True, 5, 0), (2, True, 0, 5)]
    assert urls.calibrated(rows) == urls.threshold([(4, 5, 0), (2, 0, 5)])
    assert urls.calibrated(rows[:3]) == urls.threshold([(10, 50, 0), (-10, 0, 50), (4, 5, 0)])  # no blocked url is held
