import numpy as np

from strata.llm import url_digests
from strata.llm.url_digests import DigestArray, digest_shards, judge_urls

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
ENTRIES = ["bad.example.com/", "x.org/en/1", None, "x.org/en/1", "q.com/a b", "é.com/ü"]
URLS = [
    "http://a.net/x", "http://net/x", "http://anet/x", "https://www.example.net/en/1", "http://example.net/enx",
    "HTTP://Example.COM/de/1", "http://example.com/DE/1", "http://a.example.com?x=/de/", "http://a.org/fr/", "http://x.org/en/1#f",
    "http://x.org/en/12", "http://bad.example.com", "http://deep.bad.example.com/z?y", "http://notbad.example.com/z", None, "", "no scheme",
    "a://b://c.net/d", "http://", "http:///path", "http://q.com/a b", "http://é.com/ü", "http://x.org/en/1\nnext", "http://a.b.c.d.net",
]


def verdict(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = rest[:cut].translate({c: c + 32 for c in range(65, 91)})
        tail = rest[cut:]
        path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
    fits = []
    for action, text in RULES:
        rule_host, _, rule_path = text.partition("/")
        if host and (host == rule_host or host.endswith("." + rule_host)) and path.startswith("/" + rule_path):
            fits.append((len(text), text, action))
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    labels = host.split(".")
    keys = {".".join(labels[i:]) + "/" for i in range(len(labels))} | {host + (path or "/")} if host else set()
    return host, path, None, "block" if keys & set(ENTRIES) else "allow"


def test_verdicts(spark):
    rows = [(i, u, "clash") for i, u in enumerate(URLS)] + [(None, URLS[0], "clash"), (3, URLS[9], "clash")]
    pages = spark.createDataFrame(rows, "page_id long, url string, key string")
    entries = spark.createDataFrame([(e,) for e in ENTRIES], "entry string")
    for shards in (1, 5):
        got = [tuple(r) for r in judge_urls(pages, RULES, entries, n_shards=shards).collect()]
        assert sorted(got, key=str) == sorted(((i, *verdict(u)) for i, u, _ in rows), key=str)


def test_empty_list_and_table(spark):
    none = spark.createDataFrame([], "entry string")
    pages = spark.createDataFrame([(1, "http://x.org/en/1")], "page_id long, url string")
    assert judge_urls(pages, RULES, none).first()["verdict"] == "allow"
    assert judge_urls(pages.where("page_id > 1"), RULES, none).count() == 0


def test_colliding_digests_are_told_apart_by_their_strings():
    strings = [b"alpha", b"beta", b"gamma"]
    keys = np.array([7, 7, 9], np.uint64)
    offsets = np.array([0, 5, 9, 14], np.uint64)
    array = DigestArray(np.array([3], np.uint64).tobytes() + keys.tobytes() + offsets.tobytes() + b"".join(strings))
    asked = ["beta", "delta", "alpha", "gamma", "gamma"]
    assert array.contains(np.array([7, 7, 7, 9, 8], np.uint64), asked).tolist() == [True, False, True, True, False]


def test_shards_are_sorted_arrays_of_all_entries(spark):
    entries = spark.createDataFrame([(f"h{i}.com/",) for i in range(500)], "entry string")
    shards = digest_shards(entries, 4).collect()
    assert len(shards) == 4
    assert sum(len(DigestArray(bytes(s["content"])).keys) for s in shards) == 500
    for s in shards:
        keys = DigestArray(bytes(s["content"])).keys
        assert (keys[1:] >= keys[:-1]).all()


def test_shards_grow_with_the_list(spark, monkeypatch):
    entries = spark.range(2000).selectExpr("concat('host', id, '.example/path') as entry")
    assert url_digests.shards_for(entries) == 1
    assert url_digests.shards_for(entries.limit(0)) == 1
    monkeypatch.setattr(url_digests, "SHARD_BYTES", 4096)
    n = url_digests.shards_for(entries)
    assert 15 <= n <= 25
    sizes = [len(r["content"]) for r in url_digests.digest_shards(entries, n).collect()]
    assert len(sizes) == n and max(sizes) < 2 * 4096
    pages = spark.range(0, 3000, 7).selectExpr("id as page_id", "concat('http://host', id, '.example/path') as url")
    judged = url_digests.judge_urls(pages, [("allow", "org/")], entries)
    assert {r.page_id: r.verdict for r in judged.collect()} == {i: "block" if i < 2000 else "allow" for i in range(0, 3000, 7)}
