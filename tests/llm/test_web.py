"""WARC archives and URL rules."""

import gzip
import io

import pytest

from knnspark.llm import urls, warc
from knnspark.llm.registry import URL_RULES
from knnspark.session import scratch_path

PAGES = "page_id long, url string, html string"
ROWS = [(1, "http://a.org/x", "<p>one</p>"), (2, "http://b.org/é?q=1", "<p>two é</p>"), (7, "http://c.org/", "<p>one</p>"), (5, None, "<p>one</p>"),
        (8, "http://d.org/a b\r\nX-Bad: 1", None), (9, "no url", ""), (None, "http://e.org/", "<p>alone</p>"), (None, "http://f.org/", "<p>two é</p>"),
        (12, "http://g.org/", "x" * 300_000), (13, "http://g.org/", "<p>same row</p>"), (13, "http://g.org/", "<p>same row</p>"),
        (14, "http://h.org/", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n")]


def _pages(spark, rows=ROWS):
    from pyspark.sql import functions as F
    return spark.createDataFrame(rows, PAGES).repartition(3).withColumns({"size": F.lit(1), "sha1": F.lit("x"), "original": F.lit(0)})


def test_round_trip(spark):
    manifest = warc.write(_pages(spark), warc.archive_folder(spark), archive_bytes=200)
    got = warc.read(manifest, payloads=True).collect()
    assert len(got) == len(ROWS)
    want = []
    for page_id, _, html in ROWS:
        payload = (html or "").encode()
        ids = [p for p, _, h in ROWS if (h or "") == (html or "")]
        top = max((p for p in ids if p is not None), default=None)
        refers = top if top is not None and len(ids) > 1 and top != page_id else None
        want.append((page_id, "response" if refers is None else "revisit", len(payload), warc.base32_sha1(payload), refers, payload if refers is None else b""))
    order = lambda r: (r[0] is None, r[0] or 0, r[3])
    rows = [(r.page_id, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to, bytes(r.payload)) for r in got]
    assert sorted(rows, key=order) == sorted(want, key=order)
    assert {r.url for r in got if r.page_id == 8} == {"http://d.org/a%20b%0D%0AX-Bad:%201"}


def test_small_payloads_are_never_revisits(spark):
    rows = warc.with_originals(_pages(spark), revisit_bytes=11).collect()
    assert {r.page_id: r.refers_to for r in rows if r.html == "<p>one</p>"} == {1: None, 7: None, 5: None}


def test_each_record_is_a_gzip_member_and_faults_raise(spark):
    good = warc.page_member(3, "http://a/", b"payload", None, "2026-01-01T00:00:00Z")
    assert gzip.decompress(good).startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
    two = list(warc.records(io.BytesIO(good + good), chunk=7))
    assert len(two) == 2 and warc.page_of(*two[0])[0] == 3
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.records(io.BytesIO(good[:-9])))
    for old, new in ((b"payload", b"payloaX"), (b"Content-Length: ", b"Content-Length: 1"), (b"WARC/1.1", b"WRAC/1.1")):
        with pytest.raises(ValueError):
            list(warc.records(io.BytesIO(gzip.compress(gzip.decompress(good).replace(old, new)))))


def test_archives_are_bounded_and_empty_tables_have_none(spark):
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write(_pages(spark), folder, archive_bytes=200)
    assert manifest.count() > 3
    empty = warc.write(_pages(spark, []), folder + "-empty")
    assert empty.count() == 0 and warc.read(empty).collect() == []


URLS = ["http://A.Example.ORG/es/1", "https://example.org/en/12?x", "https://example.org/en", "https://example.org/en/2#y", "http://x.com/de/1", "http://x.com/fr/", "http://com/de/",
        "http://xcom/de/", "nothing", None, "", "http://", "http://org", "http://org/", "ftp://a.org?x=/es/", "http://b.notexample.org/es/", "HTTP://É.ORG/Es/", "x://y://z.org/", "http://a.org:80/",
        "http://a.net/es/"]


def brute(url):
    if not url or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut], rest[cut:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best.verdict if best else "allow"


def test_rules_equal_brute_force(spark):
    from pyspark.sql import functions as F
    rows = [(k, u) for k, u in enumerate(URLS)] + [(0, URLS[0]), (None, URLS[4])]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit(1), "token": F.lit(2), "verdict": F.lit(3)})
    got = sorted(map(tuple, urls.judge(df, URL_RULES).collect()), key=str)
    assert got == sorted(((p, *brute(u)) for p, u in rows), key=str)
    assert urls.judge(spark.createDataFrame([], "page_id long, url string"), URL_RULES).collect() == []


def test_rules_are_filed_under_their_rarest_token():
    index = urls.index_rules(URL_RULES, {"h:org": 50, "h:example": 9, "p:es": 3, "p:en": 40, "h:com": 70, "p:fr": 80, "p:de": 5})
    assert {k: sorted(r.text for r in v) for k, v in index.items()} == {
        "h:org": ["org/"], "p:es": ["example.org/es/"], "h:example": ["example.org/en/1"], "h:com": ["com/fr/"], "p:de": ["com/de/"]}
