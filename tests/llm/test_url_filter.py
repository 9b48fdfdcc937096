"""URL filters: hosts, paths and rules against plain ones; templates and their purity."""

import random
from urllib.parse import quote

import pytest

from sondage.llm import url_filter as U
from sondage.llm.queries import URL_RULES


def plain(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    k = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:k]), rest[k:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.name), default=None)


def test_hosts_paths_and_rules(spark):
    rng = random.Random(13)
    hosts = ["Org", "a.org", "example.org", "x.EXAMPLE.org", "notexample.org", "a.com", "com", "telecom", "b.net", "", "É.com"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12.html", "/fr/é", "/de/x?y=/fr/", "?/de/", "#/de/", "/de/#", "/x://y"]
    urls = [f"{s}{h}{p}" for s in ("http://", "HTTPS://", "x", "://") for h in hosts for p in paths] + [None, "", "no scheme"]
    rng.shuffle(urls)
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls)] * 2, "page_id bigint, url string")
    rows = U.judge(pages, rules=URL_RULES).collect()
    assert len(rows) == 2 * len(urls)
    for r in rows:
        host, path, rule = plain(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule.name)
        assert r["verdict"] == (rule.verdict if rule else r["verdict"])
        assert r["verdict"] in ("allow", "block")


@pytest.fixture(scope="module")
def judged(spark):
    """Host a: /ads/* blocked, /news/* allowed; half of the pages have no label. Host b: no labels."""
    rng = random.Random(14)
    rows = []
    for k in range(400):
        kind = rng.choice(["ads", "news"])
        label = None if k % 2 else float(kind == "ads")
        rows.append((k, f"http://a.net/{kind}/{rng.randrange(10**6)}.html", label))
    for k in range(400, 500):
        rows.append((k, f"http://b.net/{rng.choice(['ads', 'news'])}/{rng.randrange(10**6)}.html", None))
    rows += [(k, f"http://a.net/{quote(''.join(rng.choice('ghijkl') for _ in range(9)))}/x", None) for k in range(500, 540)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, bad double")
    return {r["page_id"]: (rows[r["page_id"]][1], r) for r in U.judge(pages, blocked="bad").collect()}


def test_templates_follow_their_labels(judged):
    for url, r in judged.values():
        if "/ads/" in url:
            assert (r["template"], r["verdict"]) == ("/ads/*.html", "block")
        elif "/news/" in url:
            assert (r["template"], r["verdict"]) == ("/news/*.html", "allow")
        else:
            assert r["template"] == "/*/x" or r["template"] == "/*/*"


def test_similar_branches_share_their_parents_purity(spark):
    """Two branches blocked alike are one: both take the purity of their parent."""
    rows = [(k, f"http://a.net/{'xy'[k % 2]}/{k}", float(k % 3 == 0)) for k in range(300)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, bad double")
    purities = {r["purity"] for r in U.judge(pages, blocked="bad").collect()}
    assert len(purities) == 1 and 0.2 < purities.pop() < 0.45


def test_odd_pages(spark):
    schema = "page_id bigint, url string, host string, path string, rule string, template string"
    rows = [(None, "http://a.com/de/1", *"abcd"), (1, None, *"abcd"), (1, None, *"abcd"), (2, "", *"abcd"), (3, "http://a.org/" + "x/" * 50_000, *"abcd")]
    pages = spark.createDataFrame(rows, schema)
    found = U.judge(pages, rules=URL_RULES).collect()
    assert sorted((str(r["page_id"]), r["verdict"]) for r in found) == [("1", "allow"), ("1", "allow"), ("2", "allow"), ("3", "allow"), ("None", "block")]
    assert U.judge(pages.where("false"), rules=URL_RULES).count() == 0
    assert U.judge(pages).where("verdict <> 'allow'").count() == 0
