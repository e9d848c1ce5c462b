from pyspark.sql import functions as F

from catalogue.llm import revisit

RECORDS = "record_id string, kind string, url string, ts long, status int, payload_digest string, headers map<string,string>, canonical_url string"
DAY = revisit.BUCKET_MS


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], RECORDS)


def found(df):
    return {r["record_id"]: (r["outcome"], r["refers_to"], r["payload_digest"], r["headers"]) for r in df.collect()}


def test_canonical_urls(spark):
    same = ["http://www.Example.org/a/", "HTTPS://example.org:443/a?utm_source=x#top", "https://u:p@example.org//a?ref=1", " http://example.org:80/a "]
    other = {"http://example.org:81/a": "example.org:81/a", "http://example.org/A": "example.org/A", "http://example.org/a?b=2&a=1": "example.org/a?a=1&b=2",
             "http://example.org": "example.org", "not a url": "not a url", "": "", None: None}
    rows = [(u,) for u in [*same, *other]]
    got = dict(spark.createDataFrame(rows, "u string").select("u", revisit.canonical_url(F.col("u"))).collect())
    assert {got[u] for u in same} == {"example.org/a"}
    assert {u: got[u] for u in other} == other


def test_latest_earlier_response_and_validators(spark):
    u = "http://example.org/x"
    rows = [
        ("r1", "response", u, 10, 200, "d1", {"ETag": '"1"', "Content-Type": "text/html", "Date": "then", "content-type": "again"}),
        ("r2", "response", u, 5 * DAY, 200, "d2", {"etag": 'W/"2"', "Last-Modified": "mon"}),
        ("r3", "response", u, 6 * DAY, 404, "d3", {"etag": '"3"'}),
        ("r4", "response", "http://example.org/y", 1, 200, "d4", None),
        ("v0", "revisit", u, 10, 304, None, {}), ("v1", "revisit", u, 11, 304, None, {"etag": 'W/"1"', "Date": "now", "Content-Length": "0"}),
        ("v2", "revisit", u, 9 * DAY, 304, None, {"ETAG": '"2"', "Expires": "never"}), ("v3", "revisit", u, 9 * DAY + 1, 304, None, {"etag": '"1"'}),
        ("v4", "revisit", u, 9 * DAY + 2, 304, None, {"last-modified": "mon"}), ("v5", "revisit", u, 9 * DAY + 3, 304, "d2", None),
        ("v6", "revisit", u, 9 * DAY + 4, 304, None, None), ("v7", "revisit", None, 5, 304, None, {}), ("v8", "revisit", u, None, 304, None, {}),
        ("v9", "revisit", "https://www.example.org/y#z", 3 * DAY, 304, "d4", {"vary": "x"}), ("va", "revisit", "http://example.org/none", 7, 304, None, {}),
    ]
    want = {
        "v0": ("missing", None, None, None),
        "v1": ("resolved", "r1", "d1", {"etag": 'W/"1"', "date": "now", "content-type": "text/html"}),
        "v2": ("resolved", "r2", "d2", {"etag": '"2"', "last-modified": "mon", "expires": "never"}),
        "v3": ("changed", "r2", None, None), "v4": ("resolved", "r2", "d2", {"etag": 'W/"2"', "last-modified": "mon"}),
        "v5": ("resolved", "r2", "d2", {"etag": 'W/"2"', "last-modified": "mon"}), "v6": ("unverified", "r2", None, None),
        "v7": ("missing", None, None, None), "v8": ("missing", None, None, None), "v9": ("resolved", "r4", "d4", {"vary": "x"}),
        "va": ("missing", None, None, None)}
    for bucket in (DAY, 1, 100 * DAY):
        assert found(revisit.resolve(frame(spark, rows), bucket)) == want


def test_ties_repeats_and_empty(spark):
    u = "http://example.org/x"
    rows = [("a", "response", u, 5, 200, "da", {}), ("b", "response", u, 5, 200, "db", {}), ("v", "revisit", u, 6, 304, "db", {}), ("v", "revisit", u, 6, 304, "db", {})]
    got = revisit.resolve(frame(spark, rows)).collect()
    assert [(r["refers_to"], r["outcome"]) for r in got] == [("b", "resolved")] * 2
    payloads = spark.createDataFrame([("a", "A"), ("b", "B")], "record_id string, payload string")
    assert [r["payload"] for r in revisit.attach_payload(revisit.resolve(frame(spark, rows)), payloads).collect()] == ["B", "B"]
    assert revisit.resolve(frame(spark, rows[:0])).count() == 0
