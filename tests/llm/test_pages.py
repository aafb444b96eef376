import gzip
import hashlib
from urllib.parse import urlsplit

from vantage.llm import files, urls, warc


def judge(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:end], rest[end:]
        host = "".join(c.lower() if c.isascii() else c for c in host)
        path = rest[:min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


def test_url_filter_matches_brute_force(spark):
    rules = urls.RULES + [("block", "a.b.example.org", "/x/y"), ("allow", "b.example.org", "/"), ("block", "org", "/fr/z(1)/")]
    seen = ["http://example.net/en/1", "https://m.EXAMPLE.net/en", "http://x.net", "http://x.net/", "http://net/", "http://notnet/",
            "http://xnet/a", "http://example.com/de/", "http://a.example.com/de", "http://u@example.com/de/1?x=/", "http://w.org/fr/#a",
            "http://w.org/fr/z(1)/q", "http://w.org/frz", "ftp://a.b.example.org/x/yz", "http://a.b.example.org/x", "http://b.example.org/",
            "http://a.org?/fr/", "http://a.org#/fr/", "no scheme net/", "://net/", "http:///net/", None, "", "http://É.Net/ä",
            "http://x.net/" + "a/" * 3000, "http://a://b.net/", "\nhttp://x.net/\n", "http://x.net:80/"]
    rows = [(i, u) for i, u in enumerate(seen)] + [(None, seen[0]), (3, seen[3]), (3, seen[3])]
    df = spark.createDataFrame([(i, u, "h", "t") for i, u in rows], "page_id long, url string, host string, token string")
    got = urls.url_filter(df, [urls.host_path_rule(*r) for r in rules]).collect()
    want = [(i, *judge(u, rules)) for i, u in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert urls.url_filter(df.limit(0), [urls.host_path_rule(*rules[0])]).collect() == []
    assert {r.verdict for r in urls.url_filter(df, []).collect()} == {"allow"}


def test_rules_are_fetched_by_their_rarest_token(spark):
    name, verdict, pattern, size, tokens = urls.host_path_rule("block", "example.net", "/en/part")
    assert (name, size, tokens) == ("example.net/en/part", 19, ["h:example", "h:net", "p:en"])
    plain = [("any", "block", "bad", 3, [])]  # without a literal token: run on every address
    df = spark.createDataFrame([(1, "http://x/bad"), (2, "http://x/good")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in urls.url_filter(df, plain).collect()} == {1: "block", 2: "allow"}


def pages(spark):
    big, other = "p" * 150 + "é", "WARC/1.1\r\n\r\nWARC-Type: response\r\n" * 9
    rows = [(9, "http://a/1", big), (3, "http://b/é 2\n", big), (7, None, big), (None, "http://n/", big), (5, "u", "short"),
            (6, "u", "short"), (1, "http://[bad", other), (2, "http://x", other), (2, "http://x", other), (8, "e", None), (10, "f", ""),
            (11, "http://l/", "ä" * 300_000), (None, "x", "n" * 200), (None, "y", "n" * 200)]
    return rows, spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, size int")


def test_warc_round_trip(spark, tmp_path):
    rows, df = pages(spark)
    folder = f"file://{tmp_path}/warc"
    got = warc.warc_round_trip(df.repartition(3), folder=folder, payload=True).collect()
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        ids = [j for j, _, h in rows if h == html and j is not None]
        first = min(ids, default=None) if len(data) >= 100 else None
        revisit = first is not None and first != i
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    assert sorted(((r.page_id, r.response["size"], r.response.digest, r.response.type, r.refers_to) for r in got), key=repr) == \
        sorted(want, key=repr)
    for r in got:
        assert r.metadata.page_id == r.page_id and r.request is not None
        if r.response.type == "response":
            assert hashlib.sha256(r.response.payload).hexdigest() == r.response.digest
    types = []
    for r in spark.read.parquet(f"{folder}/manifest").collect():
        with files.open_stream(r.path) as f:
            types += [h["WARC-Type"] for h, _ in warc.records(f)]
        assert gzip.open(r.path.removeprefix("file://")).readline() == b"WARC/1.1\r\n"
    assert sorted(types) == sorted(t for w in want for t in ("request", w[3], "metadata"))


def test_warc_takes_urls_with_any_brackets(spark, tmp_path):
    asked = {"http://a]b/x": ("a]b", "/x"), "http://a]b": ("a]b", "/"), "http://[bad/y": ("[bad", "/y"), "http://]": ("]", "/"),
             "http://[::1]:8/z?q=[1]": ("[::1]:8", "/z"), "http://h/p[0]#]": ("h", "/p[0]")}
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(asked)], "page_id long, url string, html string").coalesce(1)
    got = warc.warc_round_trip(df, folder=f"file://{tmp_path}/b").collect()
    assert {r.page_id: r.request.target for r in got} == dict(enumerate(asked))
    (listed,) = spark.read.parquet(f"file://{tmp_path}/b/manifest").collect()
    with files.open_stream(listed.path) as f:
        asks = {h["WARC-Target-URI"]: block.decode() for h, block in warc.records(f) if h["WARC-Type"] == "request"}
    assert asks == {u: f"GET {path} HTTP/1.1\r\nHost: {host}\r\n\r\n" for u, (host, path) in asked.items()}


def test_warc_asks_as_urlsplit_takes_urls_apart():
    for u in ("http://h/a/b;c?d#e", "h/a", "//h", "", "a:b", "1a:b/c", "HTTP://u@h:1?x", "mailto:a@b", "://h/x", "x#//h", "http:///p", "é://h/p", ":a/b"):
        place = urlsplit(u)
        assert warc._PARTS.match(u).groups("") == (place.netloc, place.path), u


def test_warc_rolls_over_and_takes_empty_tables(spark, tmp_path):
    _, df = pages(spark)
    listed = warc.write_warc(df.coalesce(1), f"file://{tmp_path}/w", roll=1000).collect()
    assert len(listed) > 3 and sum(r.records for r in listed) == 3 * 14
    assert warc.warc_round_trip(df.limit(0)).collect() == []
