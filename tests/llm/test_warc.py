"""Archives: exact round trip, transactions and revisits."""

import gzip
import hashlib
import os
import tempfile
from collections import Counter

from cohortium.llm import warc_transactions as A

PAGE = "page_id long, url string, html string, value string, size int"
LONG = "<p>" + "shared payload " * 20 + "</p>"
PAGES = [
    (1, "http://a/1", "<html>é 漢字 🙂</html>", "x", 1),
    (2, "http://a/2", "head\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", None, None),
    (3, None, LONG, "x", 1), (5, "http://a/5", LONG, "x", 1), (4, "http://a/4\r\nX: y", LONG, "x", 1),
    (6, "http://a/6", None, "x", 1), (7, "http://a/7", "", "x", 1), (8, "http://a/8", "short", "x", 1), (9, "http://a/9", "short", "x", 1),
    (10, "http://a/10", "z" * 100, "x", 1), (11, "http://a/11", "z" * 100, "x", 1), (12, "http://a/12", "z" * 99, "x", 1), (13, "http://a/13", "z" * 99, "x", 1),
    (14, "http://a/14", "again", "x", 1), (14, "http://a/14", "again", "x", 1), (3, None, LONG, "x", 1),
    (None, "http://a/n", LONG, "x", 1), (15, "http://a/15", "\r\n\r\n", "x", 1), (16, "http://a/16", "q" * 300_000, "x", 1),
]


def naive():
    low = {}
    for p, _, h, *_ in PAGES:
        if p is not None and len((h or "").encode()) >= 100:
            low[h] = min(p, low.get(h, p))
    out = []
    for p, _, h, *_ in PAGES:
        body = (h or "").encode()
        again = len(body) >= 100 and p != low[h]
        out.append((p, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", low[h] if again else None))
    return Counter(out)


def test_round_trip(spark):
    path = tempfile.mkdtemp(prefix="run-") + "/warc"
    got = A.archive_and_assemble(spark.createDataFrame(PAGES, PAGE), path=path).collect()
    assert Counter((r.metadata.page_id, r.response.payload_bytes, r.response.payload_digest, r.response.record_type, r.refers_to_page)
                   for r in got) == naive()
    html = {p: h or "" for p, _, h, *_ in PAGES}
    assert all(r.response.payload == html[r.metadata.page_id] for r in got if r.response.record_type == "response" and r.metadata.page_id)
    assert all(r.request.record_id and r.request.target_uri == r.response.target_uri for r in got)
    # every archive is a plain sequence of records, three to a page, with unique ids per distinct capture
    records = [h for f in os.listdir(path) if f.endswith(".gz") for h, _ in A.parse_records(gzip.open(f"{path}/{f}").read())]
    assert Counter(h["warc-type"] for h in records)["request"] == len(PAGES) == Counter(h["warc-type"] for h in records)["metadata"]
    assert len({h["warc-record-id"] for h in records}) == 3 * len({(p, u, h) for p, u, h, *_ in PAGES})


def test_empty_table(spark):
    assert A.archive_and_assemble(spark.createDataFrame([], PAGE)).count() == 0


def test_several_archives(spark):
    path = tempfile.mkdtemp(prefix="run-") + "/warc"
    A.write_archives(spark.createDataFrame(PAGES, PAGE).coalesce(1), path, archive_bytes=20_000)
    assert sum(f.endswith(".gz") for f in os.listdir(path)) > 1
    assert A.assemble(A.read_archives(spark, path)).count() == len(PAGES)
