import re

import numpy as np
import pytest
from carbonloom.llm import url_rules
from carbonloom.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "http://", "https://example.com/en/x?q#f", "https://WWW.Example.com/en/", "http://a.b.example.com/en", "http://example.com/EN/",
    "https://www.example.com/en/a/b", "http://xexample.com/en/", "http://com/", "http://com", "http://x.com?/en/", "ftp://x.net/es/1", "http://net/fr/", "http://x.net/fr",
    "http://x.org/y.com/", "a://b://c.com/", "http://é.net/es/ü", "http://x.com#/", "http://x.com/" + "p" * 5000, "http:///en/", "http://x.com:80/", "http://u@x.com/",
]


def judged(url):
    rest = (url or "").partition("://")[2] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for r in URL_RULES:
        h, _, p = r.name.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(r.name) > len(best.name)):
            best = r
    return host, path, best and best.name, best.verdict if best else "allow"


def test_rules(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = url_rules.judge(pages, URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == judged(URLS[r.page_id]), URLS[r.page_id]
    assert url_rules.judge(pages.where("page_id < 0"), URL_RULES).count() == 0
    assert {r.verdict for r in url_rules.judge(pages, (), "block").collect()} == {"block"}


@pytest.mark.parametrize("n", [1, 3, 40])
def test_globs_against_patterns(n):
    rng = np.random.default_rng(n)
    globs = ["".join(rng.choice(list("ab/.") + ["*", "**", "?"], rng.integers(1, 9))) for _ in range(n)]
    texts = ["".join(rng.choice(list("ab/."), rng.integers(0, 12))).encode() for _ in range(200)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    got = url_rules.Automaton(globs).matches(data, offsets)
    for p, glob in enumerate(globs):
        parts = re.split(r"(\*\*|\*|\?)", glob)
        pattern = "".join({"**": "(?s:.*)", "*": "[^/]*", "?": "[^/]"}.get(x, re.escape(x)) for x in parts)
        assert [bool(re.fullmatch(pattern, t.decode())) for t in texts] == got[:, p].tolist(), glob
