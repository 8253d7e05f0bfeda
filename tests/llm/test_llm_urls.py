"""The URL filter with a list of hosts given as a table, on odd and very long urls, against plain Python."""

import random

from fluvia.llm import urls


def _split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[at:]
    cut = min((path.index(c) for c in "?#" if c in path), default=len(path))
    return rest[:at].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), path[:cut]


def _verdict(host, path, listed):
    fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: (len(r.key), len(r.host)))
        return best.key, best.action
    labels = host.split(".")
    return None, "block" if any(".".join(labels[k:]) in listed for k in range(len(labels))) else "allow"


def test_a_list_of_hosts_as_a_table(spark):
    rng = random.Random(9)
    names = ["a", "b", "example", "bad", "x-y", "München", "1"]
    tops = ["com", "net", "org", "io"]
    pages = []
    for k in range(600):
        host = ".".join([*(rng.choice(names) for _ in range(rng.randrange(1, 4))), rng.choice(tops)])
        pages.append((k, f"https://{host.upper() if k % 5 == 0 else host}{rng.choice(['', '/en/7', '/de/81', '/es/', '/a?x=1', '?q', '#f'])}"))
    pages += [(1000, None), (1001, ""), (1002, "no scheme"), (1003, "://"), (1004, "ftp://bad.com"), (1004, "ftp://bad.com"), (None, "http://sub.bad.com/x"), (1005, "http://notbad.com")]
    pages += [(1006, "http://" + ".".join(["l"] * 300) + ".bad.com/" + "p" * 200_000), (1007, "http://" + "h" * 100_000 + ".org/es/" + "q" * 100_000)]
    listed = {"bad.com", "a.net", "x-y.io", "münchen.org", "nobody.has.it", "com.bad"}
    table = spark.createDataFrame([(h,) for h in listed] + [("bad.com",), (None,)], "host string")
    df = spark.createDataFrame([(*p, "v", 1) for p in pages], "page_id long, url string, verdict string, host int").select("page_id", "url", "verdict", "host")
    got = sorted(((r.page_id or -1, r.host, r.path, r.rule, r.verdict) for r in urls.judged(df, table).collect()), key=str)
    want = []
    for page_id, url in pages:
        host, path = _split(url)
        want.append((page_id or -1, host, path, *_verdict(host, path, listed)))
    assert got == sorted(want, key=str)
    assert {r.verdict for r in urls.judged(df.where("page_id = 1004"), table.limit(0)).collect()} == {"allow"}
    assert urls.judged(df.limit(0), table).count() == 0
