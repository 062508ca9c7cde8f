import itertools
import random
import re
from collections import Counter

from homestat.llm import urlfilter as U
from homestat.llm.queries import QUERIES


def parts(url):
    if url is None or "://" not in url:
        return "", "", []
    scheme, rest = url.split("://", 1)
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    query = re.match(r"[^?#]*\?([^#]*)", url)
    tokens = {f"s:{scheme}"} | {f"h:{x}" for x in host.split(".")} | {f"p:{x}" for x in path.split("/")}
    tokens |= {f"q:{x.split('=')[0]}" for x in (query[1].split("&") if query else [])}
    tokens |= {f"f:{url.split('#', 1)[1]}"} if "#" in url else set()
    return host, path, {t for t in tokens if len(t) > 2}


def listed(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in U.LISTED if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def brute(urls, how=U.Mining()):
    rows = [(*parts(u), *listed(*parts(u)[:2])) for u in urls]
    labelled = [(t, v) for _, _, t, r, v in rows if r]
    n = len(labelled)
    least = -int(-how.min_support * n // 1)
    both, left = Counter(), Counter()
    for tokens, verdict in labelled:
        for k in range(1, how.max_tokens + 1):
            for combo in itertools.combinations(sorted(tokens), k):
                left[combo] += 1
                both[combo, verdict] += 1
    found = [(c, v, m / left[c], m) for (c, v), m in both.items() if m >= least and m / left[c] >= how.min_confidence]
    kept = []
    for r in sorted(found, key=lambda r: (len(r[0]), r[0], r[1])):
        if not any(k[1] == r[1] and k[2] >= r[2] and set(k[0]) < set(r[0]) for k in kept):
            kept.append(r)
    kept.sort(key=lambda r: (-r[2], -r[3], len(r[0]), r[0], r[1]))
    out = []
    for host, path, tokens, rule, verdict in rows:
        mined = next((v for c, v, *_ in kept if set(c) <= set(tokens)), "allow")
        out.append((host, path, rule, verdict or mined))
    return out, kept


def test_matches_brute_force(spark, corpus):
    pages = spark.read.parquet(f"{corpus}/pages.parquet").select("page_id", "url").collect()
    want, rules = brute([r.url for r in pages])
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in QUERIES["op4_url_filter"](spark, corpus).collect()}
    assert rules and got == {r.page_id: w for r, w in zip(pages, want)}
    assert {"allow", "block"} == {v for _, _, rule, v in want if rule is None}


def judged(spark, urls):
    out = U.judge(spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")).orderBy("page_id").collect()
    return [(r.host, r.path, r.rule, r.verdict) for r in out]


def test_many_shared_fields_stay_cheap(spark):
    fields = "&".join(f"utm{i}=x" for i in range(40))
    hosts = ["a.net", "b.example.com", "c.example.net", "d.org"]
    paths = ["/de/x", "/en/y", "/fr/z"]
    urls = [f"https://{hosts[i % 4]}{paths[i % 3]}?{fields}" for i in range(60)] + [f"http://other.dev/{p}?{fields}" for p in "ab"]
    assert judged(spark, urls) == brute(urls)[0]


def test_fields_on_some_pages_match_brute_force(spark):
    own = random.Random(3)
    hosts = ["a.net", "b.example.com", "c.example.net", "d.org", "e.dev", "f.dev"]
    urls = []
    for _ in range(150):
        host = own.choice(hosts)
        fields = [f"q{i}=1" for i in range(14) if own.random() < (0.95 if i < 5 else 0.3 + 0.5 * (host < "c"))]
        urls.append(f"https://{host}/{own.choice(['de', 'en', 'fr'])}/p?{'&'.join(fields)}")
    want, rules = brute(urls)
    assert len({len(r[0]) for r in rules}) > 1
    assert judged(spark, urls) == want


def test_no_labelled_page_and_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://x.dev/a", "h"), (1, "http://x.dev/a", "h"), (None, None, None)], "page_id long, url string, host string")
    out = U.judge(pages)
    assert out.columns == ["page_id", "url", "host", "host_", "path", "rule", "verdict"]
    assert [r.verdict for r in out.collect()] == ["allow"] * 3
