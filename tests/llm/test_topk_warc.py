"""Top-k search against brute force and archives as an exact round trip."""

import base64
import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from riskspark.llm.shared import stage_path
from riskspark.llm.topk import accumulate, top_k
from riskspark.llm.warc import LoserTree, archive_pages, parse_records, url_key, write_archives


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def _brute(rows, k):
    ok = [(i, v) for i, v, _ in rows if i is not None and v is not None
          and all(x is not None and np.isfinite(x) for x in v)]
    ints = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in ok]
    out = []
    for a, (i, q) in enumerate(ints):
        if i % 20 == 0:
            scores = sorted((-sum(x * y for x, y in zip(q, c)), j) for b, (j, c) in enumerate(ints) if b != a)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return sorted(out)


def test_topk_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([0.0, 0.0, rng.uniform(-1, 1)]) for _ in range(8)], i % 3) for i in range(300)]
    rows += [(300 + i, [0.5] * 8, 0) for i in range(60)]  # ties
    rows += [(400, None, 0), (420, [1.0, None], 0), (440, [float("nan")] * 8, 0), (460, [float("inf")] * 8, 0),
             (480, [], 0), (500, [0.25] * 3, 0), (520, [0.1] * 12, 0), (None, [0.5] * 8, 0), (20, [0.5] * 8, 0)]
    for block in (4096, 70):
        found = top_k(_vectors(spark, rows), F.col("vec_id") % 20 == 0, 20, query_block=block, candidate_block=block)
        assert sorted(map(tuple, found.collect())) == _brute(rows, 20)
    assert top_k(_vectors(spark, []), F.col("vec_id") % 20 == 0).collect() == []
    few = top_k(_vectors(spark, rows[:3]), F.col("vec_id") % 20 == 0).collect()
    assert sorted(map(tuple, few)) == _brute(rows[:3], 20)


def test_accumulate_is_exact_for_large_weights():
    for scale in (3, 2 ** 20, 2 ** 35):
        rng = random.Random(scale)
        q, c = ([np.array([rng.randint(-scale, scale) for _ in range(5)], object) for _ in range(4)] for _ in range(2))
        want = [[sum(int(x) * int(y) for x, y in zip(a, b)) for b in c] for a in q]
        assert accumulate(q, c).tolist() == want


def _pages():
    shared = "<p>shared</p>\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"
    rows = [(i, f"http://Www.a{i % 7}.example.com/p/{i % 5}?q={i}#x", f"<html>é {i % 90}</html>") for i in range(200)]
    rows += [(1000 + i, "https://hot.example.org:8443/", shared) for i in range(150)]
    return rows + [(2000, None, "x"), (2001, "bad\r\nurl %\n", "x"), (2002, "http://[bad", None), (2003, "", ""),
                   (None, "http://n.example", "x"), (None, "http://n.example", "only here"), (2003, "", "")]


def test_archives_round_trip(spark):
    rows = _pages()
    pages = spark.createDataFrame([(*r, 1, "k") for r in rows], "page_id long, url string, html string, sha int, kept_id string")
    found = archive_pages(pages, records_per_file=30).collect()
    largest = {}
    for i, _, html in rows:
        largest[html or ""] = max(largest.get(html or "", -1), -1 if i is None else i)
    want = []
    for i, _, html in rows:
        data, best = (html or "").encode(), largest[html or ""]
        same = best == -1 or i == best
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                     "response" if same else "revisit", None if same else best))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)
    order = [(r.url_key, r.captured_at, -1 if r.page_id is None else r.page_id) for r in found]
    assert order == sorted(order) and len({r.archive for r in found}) > 5
    # smaller payloads than the limit are all responses
    small = archive_pages(pages, least_revisit_bytes=20).collect()
    assert all(r.record_type == "response" for r in small if r.payload_bytes < 20)
    assert any(r.record_type == "revisit" for r in small)


def test_archives_parse_at_their_offsets(spark):
    pages = spark.createDataFrame(_pages(), "page_id long, url string, html string")
    path = stage_path(spark, "test-warc")
    write_archives(pages, path)
    files = [bytes(r.content) for r in spark.read.format("binaryFile").load(path).select("content").collect()]
    records = [(at, headers, block, data) for data in files for at, headers, block in parse_records(data)]
    assert len(records) == len(_pages())
    assert all(data[at:at + 5] == b"WARC/" for at, _, _, data in records)
    assert not [h for _, h, _, _ in records if " " in h["WARC-Target-URI"] or "\n" in h["WARC-Target-URI"]]


def test_no_pages(spark):
    assert archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_loser_tree_merges_any_number_of_runs():
    rng = random.Random(1)
    for k in range(1, 18):
        runs = [sorted([(str(rng.randrange(9)), "t", rng.randrange(5), "r", None, 0, "", f"a{j}", i)
                        for i in range(rng.randrange(6))], key=lambda r: (r[0], r[1], r[2], r[7], r[8])) for j in range(k)]
        merged = list(LoserTree(runs))
        assert merged == sorted((r for run in runs for r in run), key=lambda r: (r[0], r[1], r[2], r[7], r[8]))
    assert list(LoserTree([])) == []


def test_url_keys():
    assert url_key("http://www.Example.com/a/B?x=1#f") == "com,example)/a/B?x=1"
    assert url_key("https://a.b.org:8443") == "org,b,a:8443)/" and url_key("https://a.b:443/x") == "b,a)/x"
    assert url_key("http://[bad") == "http://[bad" and url_key("") == "" and url_key("urn:X") == "urn:x"
