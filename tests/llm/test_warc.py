"""Archives written and read back, with magic lines inside payloads."""

import hashlib
import random

from courtlake.llm import warc

FAKE = warc.MAGIC + "WARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"


def pages():
    rows = [(1, "http://a/ü\r\nX", "a" * 1000), (2, None, "a" * 1000), (3, "u", None), (4, "u", ""),
            (5, "u", "pre " + FAKE + "post"), (6, "u", FAKE * 3), (7, "u", warc.MAGIC),
            (8, "u", "x" * 5000 + warc.MAGIC + "Content-Length: 99999\r\n\r\n"), (9, "u", "é" * 600 + "\r\n\r\n"),
            (10, "u", "end" + warc.MAGIC), (11, "u", warc.MAGIC * 3), (12, "u", "é" * 600 + "\r\n\r\n"),
            (13, "u", "small"), (14, "u", "small"), (15, "u", "WARC/1.1\r"), (16, "u", "\nWARC/1.1")]
    draw = random.Random(3)
    return rows + [(100 + i, f"http://h/{i}", draw.choice(
        [FAKE, warc.MAGIC, "<p>x</p>" * draw.randint(1, 900), "z\r\n\r\n" * 50])) for i in range(120)]


def expected(rows):
    best = {}
    for i, _, html in rows:
        if len((html or "").encode()) >= 1000:
            best[html] = max(best.get(html, i), i)
    out = []
    for i, _, html in rows:
        body, owner = (html or "").encode(), best.get(html, i)
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "response" if owner == i else "revisit",
                    None if owner == i else owner))
    return sorted(out)


def test_round_trip(spark):
    table = spark.createDataFrame([(*r, 0) for r in pages()], "page_id long, url string, html string, digest int")
    assert sorted(map(tuple, warc.round_trip(table.coalesce(1)).collect())) == expected(pages())
    assert warc.round_trip(table.limit(0)).collect() == []


def test_repeated_ids(spark):
    """One id with two large payloads, both of which other pages repeat, and repeated rows."""
    a, b = "a" * 2000, "b" * 3000
    rows = [(9, "u", a), (9, "u", b), (1, "u", a), (2, "u", b), (2, "u", b), (9, "u", a), (9, None, "tiny"), (3, "u", "c" * 400_000)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(map(tuple, warc.round_trip(table).collect()), key=repr)
    assert got == sorted(expected(rows), key=repr) and len(got) == len(rows)


def test_files_cut_anywhere(spark, tmp_path):
    table = spark.createDataFrame(pages(), "page_id long, url string, html string").coalesce(1)
    warc.write(table, str(tmp_path / "warc"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = warc.read(spark, str(tmp_path / "warc")).collect()
        assert warc.verify(spark, str(tmp_path / "warc")).collect() == []
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    payload = {i: (html or "").encode() for i, _, html in pages()}
    assert sorted(r.page_id for r in got) == sorted(payload)
    assert all(bytes(r.payload) == payload[r.page_id] for r in got if r.record_type == "response")
