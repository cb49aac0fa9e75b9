"""Web archives: pages written as WARC records, read back with every record boundary verified.

Writing: the page with the largest page_id among equal payloads of at least ``REVISIT_BYTES`` is a
response, the others are revisits that name it and hold no payload; smaller ones are all
responses. A record is a row of a text file whose line ends are the two line breaks that end
every record, so the files are plain WARC/1.1 and Spark writes them.

Reading: files are cut where the magic line stands, wherever Spark splits them. Each such place
is a candidate, a real record or the same bytes inside a payload. A task knows the lengths of
its pieces, so it tells where a candidate starts, and its header where its successor starts.
First every task jumps along the successors inside its own split, which leaves for a candidate
the first place beyond the split; these pointers are then doubled over the splits, from the start of
each file, until nothing new is reached. Candidates that the chain reaches are records, all others
are part of the record before them and are put back into its payload.

Null html is an empty payload, a null page_id an empty one. Line breaks in a url are escaped.
Payloads are compared by bytes; rows that repeat a page_id with the same payload are all
responses if that id is the largest. Record ids come from page_id, which may repeat with other
payloads; so a revisit finds the payload it names by that id and by its own payload digest. A file
whose chain ends before its end is reported by ``verify``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.llm.common import bounded_batches, pick, shared_path, stored

REVISIT_BYTES = 1000
# Fixed values of the format.
MAGIC, END = "WARC/1.1\r\n", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
RECORDS_PER_FILE = 100_000
STRETCH = 1 << 16


def write(pages: DataFrame, path: str) -> None:
    """The archive of ``pages`` (page_id, url, html) at ``path``: a folder of WARC files."""
    rows = pick(pages, "page_id", "url", "html").select(
        "page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1("html"))
    large = F.octet_length("html") >= REVISIT_BYTES
    # Summed in each task first: a payload that a third of all pages share is one row per task.
    owners = stored(rows.where(large).groupBy(F.unhex("digest").alias("shared")).agg(
        F.max("page_id").alias("owner"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "warc-owners")
    placed = rows.join(owners, (F.unhex("digest") == F.col("shared")) & large, "left")
    revisit = F.col("shared").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))
    placed.select(_record(revisit).alias("value")).write.option("lineSep", END).option(
        "maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def _record(revisit: Column) -> Column:
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("html").cast("string"), F.lit(END))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    named = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    return F.concat(
        F.lit(MAGIC), named("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        named("WARC-Record-ID", _urn(F.col("page_id"))), named("WARC-Date", F.lit(DATE)),
        named("WARC-Target-URI", url), named("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(named("WARC-Refers-To", _urn(F.col("owner"))),
                                 named("WARC-Profile", F.lit(PROFILE)))).otherwise(F.lit("")),
        named("Content-Type", F.lit("application/http;msgtype=response")),
        named("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, place, offset, size, next, body): what lies between two magic lines.

    ``offset`` is where the magic line before the piece starts, relative to the split's first
    magic line; ``next`` where the record after it would start, by its header (null without one).
    """
    bounded_batches(spark)
    lines = spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.col("value").cast("binary").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, place, offset = None, 0, 0
        for batch in batches:
            files, splits = batch.column("file").to_pylist(), batch.column("split").to_pylist()
            bodies = batch.column("body")
            out = []
            for name, split, body in zip(files, splits, bodies):
                if (name, split) != at:
                    at, place, offset = (name, split), 0, 0
                size = len(body.as_buffer())
                head = size if place == 0 and split == 0 else None
                # The piece before a file's first magic line is no record.
                follow = None if head is not None else _length(body.as_buffer().to_pybytes())
                start = offset - len(MAGIC)
                out.append((place, start, size, None if follow is None else start + len(MAGIC) + follow))
                place, offset = place + 1, offset + size + len(MAGIC)
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("split"), *[pa.array(c, pa.int64()) for c in columns], bodies],
                ["file", "split", "place", "offset", "size", "next", "body"])

    return lines.mapInArrow(
        run, "file string, split long, place long, offset long, size long, next long, body binary")


def _length(body: bytes) -> int | None:
    """Bytes from behind the magic line to the successor, by the header; None without a valid one."""
    cut = body.find(b"\r\n\r\n")
    if cut < 0:
        return None
    for line in body[:cut].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon and name.strip().lower() == b"content-length" and value.strip().isdigit():
            return cut + 4 + int(value) + 4
    return None


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, body) of every record that the chain from its file's start reaches.

    ``body`` is the record without its magic line and closing line breaks.
    """
    found = stored(pieces(spark, path).drop("body"), "warc-pieces")
    lengths = found.groupBy("file", "split").agg(F.sum(F.col("size") + len(MAGIC)).alias("bytes"))
    lengths = lengths.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("split", "bytes"))).alias("all"))
    starts = lengths.select("file", F.posexplode("all").alias("nth", "one"), "all").select(
        "file", F.col("one.split").alias("split"), F.aggregate(
            F.slice("all", F.lit(1), F.col("nth")), F.lit(0).cast("long"), lambda s, x: s + x["bytes"]).alias("base"),
        F.aggregate("all", F.lit(0).cast("long"), lambda s, x: s + x["bytes"]).alias("whole"))
    starts = stored(starts, "warc-splits")
    known = found.join(starts, ["file", "split"])
    candidates = known.where("next is not null").select(
        "file", "split", (F.col("base") + F.col("offset")).alias("at"),
        (F.col("base") + F.col("next")).alias("to"))
    # Jump inside the split: every candidate's last place in it, and the first place beyond.
    ahead = candidates.groupBy("file", "split").applyInArrow(
        _jump, "file string, split long, at long, beyond long")
    ahead = stored(ahead, "warc-ahead")
    entries = _entries(ahead, starts)
    # The files are read again, now knowing where the first record of every split starts: one row
    # per split, stored so that Spark sees its size and need not deal out the payloads.
    known_starts = stored(starts.drop("whole").join(entries, ["file", "split"], "left"), "warc-starts")
    placed = pieces(spark, path).join(known_starts, ["file", "split"]).select(
        "file", "split", "place", (F.col("base") + F.col("offset")).alias("at"),
        (F.col("base") + F.col("next")).alias("to"), "entry", "body")
    spans = placed.sortWithinPartitions("file", "split", "place").mapInArrow(
        _walk, "kind string, file string, at long, to long, body binary")
    # Records that end in a later split, and the pieces there: few, put together by stretches.
    parts = stored(spans.where("kind <> 'whole'"), "warc-parts")
    opened = parts.where("kind = 'open'").select("file", F.col("at").alias("offset"), "to", "body")
    touched = opened.drop("body").withColumn("stretch", F.explode(F.sequence(
        F.floor(F.col("offset") / STRETCH), F.floor(F.col("to") / STRETCH))))
    tails = parts.where("kind = 'tail'").drop("to").withColumn("stretch", F.floor(F.col("at") / STRETCH)).join(
        touched, ["file", "stretch"]).where("at >= offset and at < to").select("file", "offset", "to", "at", "body")
    magic = F.lit(MAGIC.encode())
    joined = opened.withColumn("at", F.col("offset")).select("file", "offset", "to", "at", "body").union(tails)
    joined = joined.groupBy("file", "offset", "to").agg(
        F.sort_array(F.collect_list(F.struct("at", "body"))).alias("parts")).select(
        "file", "offset", "to", F.aggregate(
            F.slice("parts", F.lit(2), F.size("parts")), F.get("parts", F.lit(0))["body"],
            lambda body, p: F.concat(body, magic, p["body"])).alias("body"))
    whole = spans.where("kind = 'whole'").select("file", F.col("at").alias("offset"), "to", "body")
    size = F.col("to") - F.col("offset") - len(MAGIC) - len(END)
    return whole.unionByName(joined).select("file", "offset", F.substr("body", F.lit(1), size.cast("int")).alias("body"))


def _jump(table: pa.Table) -> pa.Table:
    at, to = table.column("at").to_numpy(), table.column("to").to_numpy()
    order = np.argsort(at)
    at, beyond = at[order], to[order].copy()
    place = np.searchsorted(at, beyond)
    inside = (place < len(at)) & (at[np.minimum(place, len(at) - 1)] == beyond)
    # A successor lies behind its record, so one pass from the end settles all of them.
    for i in range(len(at) - 1, -1, -1):
        if inside[i]:
            beyond[i] = beyond[place[i]]
    return pa.table({"file": table.column("file").take(pa.array(order)),
                     "split": table.column("split").take(pa.array(order)),
                     "at": pa.array(at), "beyond": pa.array(beyond)})


def _entries(ahead: DataFrame, starts: DataFrame) -> DataFrame:
    """(file, split, entry): the first reached place of every split, by pointer doubling."""
    first = starts.groupBy("file").agg(F.min("whole").alias("whole")).select(
        "file", F.lit(0).cast("long").alias("at"))
    # Only places that a jump ends at, or a file's start, can be entries.
    heads = ahead.select("file", F.col("beyond").alias("at")).distinct().union(first).distinct()
    jump = stored(heads.join(ahead, ["file", "at"]).select("file", "at", "split", "beyond").distinct(), "warc-jump")
    reached = first.join(jump, ["file", "at"], "left_semi")
    step = jump.select("file", "at", "beyond")
    before = -1
    while True:
        reached = stored(reached, "warc-reached")
        now = reached.count()
        if now == before:
            break
        before = now
        onward = reached.join(step, ["file", "at"]).select("file", F.col("beyond").alias("at"))
        reached = reached.union(onward.join(jump, ["file", "at"], "left_semi")).distinct()
        twice = step.select("file", F.col("at").alias("beyond"), F.col("beyond").alias("far"))
        step = stored(step.join(twice, ["file", "beyond"], "left").select(
            "file", "at", F.coalesce("far", "beyond").alias("beyond")), "warc-step")
    return reached.join(jump, ["file", "at"]).groupBy("file", "split").agg(F.min("at").alias("entry"))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records that lie in one split, those that go on behind it, and pieces before its entry."""
    split, record, now = None, None, None
    out: list[tuple] = []

    def close() -> None:
        if record is not None:
            name, at, to, bodies = record
            body = MAGIC.encode().join(bodies)
            out.append(("whole" if at + len(MAGIC) + len(body) == to or ended else "open", name, at, to, body))

    def flush() -> pa.RecordBatch:
        kind, name, at, to, body = zip(*out) if out else [()] * 5
        out.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.string()), pa.array(name, pa.string()), pa.array(at, pa.int64()),
             pa.array(to, pa.int64()), pa.array(body, pa.binary())], ["kind", "file", "at", "to", "body"])

    for batch in batches:
        for row in batch.to_pylist():
            if (row["file"], row["split"]) != split:
                ended = False
                close()
                split, record, now = (row["file"], row["split"]), None, row["entry"]
            if now is not None and row["at"] == now:
                ended = True
                close()
                now = row["to"]
                record = None if now is None else (row["file"], row["at"], now, [row["body"]])
            elif record is not None:
                record[3].append(row["body"])
            elif row["entry"] is None or row["at"] < row["entry"]:
                out.append(("tail", row["file"], row["at"], None, row["body"]))
        yield flush()
    ended = False
    close()
    yield flush()


def verify(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes, end): files whose chain of records does not end where the file does."""
    size = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col("length").alias("bytes"))
    last = records(spark, path).groupBy("file").agg(F.max(
        F.col("offset") + len(MAGIC) + F.octet_length("body") + len(END)).alias("end"))
    return size.join(last, "file", "left").where(~F.col("bytes").eqNullSafe(F.col("end")))


def read(spark: SparkSession, path: str) -> DataFrame:
    """page_id, record_type, refers_to, digest, payload of every record; revisits have none."""
    body = records(spark, path).select("body", F.col("body").cast("string").alias("text"))
    head = F.substring_index("text", END, 1)
    field = lambda name: F.regexp_extract("head", rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    cut = body.withColumn("head", head).withColumn(
        "http", F.substring_index(F.substr("text", F.length("head") + 1 + len(END)), END, 1))
    skip = F.octet_length("head") + F.octet_length("http") + 2 * len(END)
    return cut.select(
        page(field("WARC-Record-ID")).alias("page_id"), field("WARC-Type").alias("record_type"),
        page(field("WARC-Refers-To")).alias("refers_to"),
        F.substring_index(field("WARC-Payload-Digest"), ":", -1).alias("digest"),
        F.when(field("WARC-Type") == "response", F.substr("body", (skip + 1).cast("int"))).alias("payload"))


def round_trip(pages: DataFrame) -> DataFrame:
    """The archive of ``pages``, written and read back: one row per page, digests recomputed."""
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    write(pages, path)
    back = stored(read(spark, path).select(
        "page_id", "record_type", "refers_to", "digest", F.octet_length("payload").cast("long").alias("bytes"),
        F.sha1("payload").alias("sha1")), "warc-read")
    full = back.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), F.col("bytes").alias("of_bytes"), F.col("sha1").alias("of_sha1"))
    # An id may hold several payloads; a revisit's own digest tells which one it means.
    full = full.where(f"of_bytes >= {REVISIT_BYTES}").distinct().withColumn("digest", F.col("of_sha1"))
    revisits = back.where("record_type = 'revisit'").join(full, ["refers_to", "digest"])
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return back.where("record_type = 'response'").select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("sha1").alias("payload_digest"),
        "record_type", "refers_to").unionByName(revisits.select(
            "page_id", F.col("of_bytes").alias("payload_bytes"), F.col("of_sha1").alias("payload_digest"),
            "record_type", "refers_to")).select(columns)
