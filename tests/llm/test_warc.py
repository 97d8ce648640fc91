import base64
import hashlib
import heapq
import random

import pytest

from siltbed.llm import warc

SCHEMA = "page_id long, url string, html string, first int, sha string"


def brute(rows, min_bytes=0):
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        same = [j for j, _, g in rows if (g or "") == (h or "") and j is not None]
        first = min(same, default=None)
        revisit = len(p) >= min_bytes and len([1 for _, _, g in rows if (g or "") == (h or "")]) > 1 and first is not None and i != first
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def test_loser_tree_merges_like_a_heap():
    r = random.Random(2)
    for k in [0, 1, 2, 3, 5, 8, 13]:
        runs = [sorted((r.randrange(50), n) for _ in range(r.randrange(0, 30))) for n in range(k)]
        assert list(warc.loser_tree([iter(x) for x in runs], key=lambda e: e)) == list(heapq.merge(*runs))


def test_matches_brute_force(spark, monkeypatch):
    from siltbed.llm import common

    r = random.Random(4)
    rows = [(i, r.choice(["http://www.b.org/x?q=1", "https://a.example.com/é ü", f"http://h{i % 9}.com:8080/{i}", None, "no url", "http://[bad"]), r.choice(["<p>same</p>", f"<p>{i} é</p>", None, "", "\r\n\r\n"])) for i in range(200)]
    rows += [(300, "http://z.com/", "long " * 100_000), (None, "http://z.com/", "<p>same</p>"), (None, "http://z.com/", "only here"), (5, rows[5][1], rows[5][2])]
    r.shuffle(rows)
    df = spark.createDataFrame([(*x, 1, "s") for x in rows], SCHEMA).repartition(3)
    for least in (0, 5):
        got = warc.captures(df, min_bytes=least).collect()
        assert sorted([tuple(x)[:5] for x in got], key=str) == brute(rows, least)
        keys = [(x.url_key, x.timestamp, x.page_id is not None, x.page_id or 0) for x in got]
        assert keys == sorted(keys)
        # many small archives, two passes of merges or more, ranges that cut blocks; all payloads hot
        monkeypatch.setattr(common, "HOT_SHARE", 10**9)
        archives = warc.write(df, min_bytes=least, archive_bytes=2000)
        assert archives.count() > 20
        again = warc.history(warc.runs(archives, 3), fan_in=4, range_rows=10, block_rows=4).collect()
        assert sorted([(x.page_id, x.payload_bytes, x.payload_digest, x.record_type, x.refers_to) for x in again], key=str) == brute(rows, least)
        keys = [(x.url_key, x.timestamp, x.page_id is not None, x.page_id or 0) for x in again]
        assert keys == sorted(keys)
        monkeypatch.undo()


def test_archives_are_plain_warc(spark):
    df = spark.createDataFrame([(1, "http://a.com/p", "<p>x</p>", 1, "s"), (2, "http://a.com/q", "<p>x</p>", 1, "s")], SCHEMA)
    data = warc.write(df.coalesce(1)).first().data
    seen = [warc.parse(c) for _, _, c in warc.members(data)]
    assert [h["warc-type"] for h, _ in seen] == ["warcinfo", "response", "revisit"]
    assert seen[1][1].endswith(b"\r\n\r\n<p>x</p>") and seen[2][0]["warc-refers-to"] == "<urn:page:1>"
    with pytest.raises(ValueError):
        list(warc.members(data[:-5]))


def test_ids_must_be_integers(spark):
    with pytest.raises(TypeError):
        warc.captures(spark.createDataFrame([("a", "u", "h")], "page_id string, url string, html string"))


def test_keys_and_empty_table(spark):
    assert warc.url_key("HTTP://WWW.Example.COM:80/A?b=1#f") == "com,example)/A?b=1"
    assert warc.url_key("https://a.b.org") == "org,b,a)/" and warc.url_key(None) == ""
    assert warc.captures(spark.createDataFrame([], SCHEMA)).count() == 0
