import fnmatch
import random
import re

from quarry.llm import url_filter as U

from .edge import rows_of


def as_regex(glob):
    return re.compile("".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in glob), re.S)


def test_automaton_equals_regular_expressions():
    r = random.Random(3)
    globs = ["".join(r.choices("ab*?#/", k=r.randint(0, 12))) for _ in range(60)] + ["a" * 150 + "*b", "*" + "ab" * 70, "", "*", "**a**"]
    texts = ["".join(r.choices("ab#/", k=r.randint(0, 14))) for _ in range(400)] + ["a" * 151 + "b", "x" + "ab" * 70, ""]
    m = U.ShiftAnd(globs).matches([t.encode() for t in texts])
    for i, t in enumerate(texts):
        for j, g in enumerate(globs):
            assert m[i, j] == bool(as_regex(g).fullmatch(t)), (t, g)
    assert fnmatch.fnmatchcase("ab", "a?")


def judged(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fit:
        return host, path, max(fit)[1], max(fit)[2]
    return host, path, None, "block" if any(as_regex(g).fullmatch(f"{host}#{path}") for g in U.BLOCKED) else "allow"


def test_judge(spark):
    urls = [
        None, "", "no scheme", "http://", "https://WWW.Example.ORG/es/1", "http://example.org/en/12?x=/es/", "http://org/", "http://org", "http://.org/x",
        "ftp://a.com/fr/9#top", "http://a.com/de/", "http://xcom/de/", "http://cheap-pills.example.net/", "http://evil.net/x.org/", "http://a.net/ads/1",
        "http://ünï.com/fr/é", "http://h.net/" + "long/" * 20000, "a://b://c.org/", "http://spam.org/x", "http://user@host:80.com/fr/",
    ]
    rows = [(i, u) for i, u in enumerate(urls)] + [(0, None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string")
    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in rows_of(U.judge(df))]
    assert sorted(got, key=str) == sorted(((i, *judged(u)) for i, u in rows), key=str)
    assert U.judge(df.limit(0)).count() == 0
