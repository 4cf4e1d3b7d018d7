"""WARC writing, and reading by boundary chains.

Writing: one record for each page, by Spark's text writer, so files are committed as tables are. Of pages with equal
payloads of REVISIT_BYTES or more, that with the largest page_id is a response and the others are revisits of it.

Reading: files are split anywhere. Each task cuts its part at the magic line and emits, for each piece, the offset
of the magic and, where a valid header follows, the offset at which the next record must begin. Pieces that follow
each other without a gap are drawn together to nodes; pointer jumping from the start of each file finds the nodes on
the chain, and only records in them are real. A magic line inside a payload starts no record: the record's length
leads past it. Payloads that hold magic lines are put together again from their pieces.

Defined results: a null html is an empty payload; a null url gives no target; a null page_id is written as `null`
and read back as null, and in a group of equal payloads it is a revisit unless all ids are null; rows with the same
page_id and payload are all responses if that id is the largest; control characters in urls are percent-encoded;
empty tables give empty archives. Records after a damaged one are not on the chain and are not returned.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.llm.common import bound_batches, new_path, stage

MAGIC = "WARC/1.0\r\n"
REVISIT_BYTES = 1000
FILE_RECORDS = 20_000
#: Rows up to which a list of pieces is broadcast.
BROADCAST_PIECES = 100_000
#: A group of equal payloads is dealt to this many partitions.
SALT = 32
CAPTURED = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def write_warc(pages: DataFrame, path: str) -> None:
    """Write page_id, url, html of all pages to a folder of WARC files."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("payload"), F.octet_length(html).alias("n"), F.sha1(html.cast("binary")).alias("digest"))
    same = rows.where(F.col("n") >= REVISIT_BYTES).groupBy("digest", "n").agg(F.max("page_id").alias("top"), F.count("*").alias("pages"))
    same = stage(same.where("pages > 1 and top is not null").select(F.col("digest").alias("d"), "top", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("s")), "same")
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALT)).cast("int")
    both = rows.withColumn("salt", salt).join(same, (F.col("digest") == F.col("d")) & (F.col("salt") == F.col("s")), "left")
    revisit = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))

    def line(name: str, value) -> F.Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    def urn(c: str) -> F.Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))

    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    url = F.regexp_replace(F.regexp_replace(F.col("url"), "\r", "%0D"), "\n", "%0A")
    record = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn("page_id")),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Date", F.lit(CAPTURED)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn("top")), line("WARC-Profile", F.lit(PROFILE)))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"), block, F.lit("\r\n"),
    )
    both.select(record.alias("value")).write.option("lineSep", "\r\n").option("maxRecordsPerFile", FILE_RECORDS).text(path)


_LENGTH = re.compile(rb"^content-length:[ \t]*(\d{1,18})[ \t]*$", re.I | re.M)


def _span(piece: bytes) -> int | None:
    """Bytes from the end of a magic line to the next record's magic line; None without a valid header."""
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    found = _LENGTH.search(piece[:end].replace(b"\r\n", b"\n"))
    return end + 4 + int(found[1]) + 4 if found else None


def _pieces(batches):
    """Pieces in the order of the file: place in the part, offset of the piece in the part, length, span."""
    at, seq, offset = None, 0, 0
    for batch in batches:
        rows = []
        for name, part, raw in zip(batch.column("file").to_pylist(), batch.column("part").to_pylist(), batch.column("raw").to_pylist(), strict=True):
            if (name, part) != at:
                at, seq, offset = (name, part), 0, 0
            rows.append((name, part, seq, offset, len(raw), _span(raw), raw))
            seq, offset = seq + 1, offset + len(raw) + len(MAGIC)
        columns = list(zip(*rows, strict=True)) or [()] * 7
        types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["file", "part", "seq", "local", "size", "span", "raw"])


def _on_chain(pieces: DataFrame) -> DataFrame:
    """pieces: file, part, seq, pos (of the magic), size, span. Adds owner: the pos of the real record a piece
    belongs to, null for what precedes the first record or follows a broken chain."""
    whole = F.col("span") == F.col("size")
    given = pieces.withColumn("next", F.col("pos") + len(MAGIC) + F.col("span")).withColumn("whole", F.coalesce(whole, F.lit(False)))
    targets = given.where("not whole and next is not null").select(F.col("file").alias("tf"), F.col("next").alias("tp")).distinct()
    marked = given.join(targets, (F.col("file") == F.col("tf")) & (F.col("pos") == F.col("tp")), "left")
    marked = marked.selectExpr("file", "part", "seq", "pos", "next", "whole", "tp is not null or not coalesce(lag(whole) over (partition by file order by pos), false) starts")
    marked = stage(marked.selectExpr("*", "max(case when starts then pos end) over (partition by file order by pos) node"), "nodes")
    jump = stage(marked.groupBy("file", "node").agg(F.max_by("next", "pos").alias("next")).where("next is not null"), "jumps")
    reach = stage(marked.where("pos = 0 and next is not null").select("file", F.col("pos").alias("node")), "reach")
    while True:
        landed = reach.join(jump, ["file", "node"]).select("file", F.col("next").alias("node"))
        known = marked.select("file", "node").distinct()
        grown = stage(reach.union(landed.join(known, ["file", "node"], "left_semi")).distinct(), "reach")
        if grown.count() == reach.count():
            break
        reach = grown
        jump = stage(jump.join(jump.selectExpr("file", "node next", "next further"), ["file", "next"]).select("file", "node", F.col("further").alias("next")), "jumps")
    on = marked.join(reach.withColumn("real", F.lit(True)), ["file", "node"], "left")
    # in a node on the chain every piece is a record, but the last may be none at all
    real = on.withColumn("real", F.coalesce(F.col("real") & F.col("next").isNotNull(), F.lit(False)))
    owned = real.selectExpr("*", "max(case when real then pos end) over (partition by file order by pos) owner")
    ends = real.where("real and not whole").selectExpr("file f", "pos p", "next upto")
    owned = owned.join(ends, (F.col("file") == F.col("f")) & (F.col("owner") == F.col("p")), "left")
    return owned.selectExpr("file", "part", "seq", "pos", "real", "whole", "case when real or pos < upto then owner end owner")


def _parsed(batches):
    names = ["file", "offset", "record_type", "page_id", "target_uri", "refers_to", "declared_digest", "declared_bytes", "payload"]
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    for batch in batches:
        rows = []
        for name, offset, raw in zip(batch.column("file").to_pylist(), batch.column("pos").to_pylist(), batch.column("raw").to_pylist(), strict=True):
            end = raw.find(b"\r\n\r\n")
            # lines end as in _span, also where a writer left out the CR; the first length counts, as there
            lines = raw[:end].replace(b"\r\n", b"\n").decode("utf-8", "replace").split("\n")
            head = dict((k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in reversed(lines)))
            block = raw[end + 4 : _span(raw) - 4]
            stop = block.find(b"\r\n\r\n") if "http" in head.get("content-type", "") else -4
            declared = _LENGTH.search(block[: max(stop, 0)].replace(b"\r\n", b"\n"))
            ids = [int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", head.get(k, ""))) else None for k in ("warc-record-id", "warc-refers-to")]
            rows.append((name, offset, head.get("warc-type"), ids[0], head.get("warc-target-uri"), ids[1], head.get("warc-payload-digest", "").removeprefix("sha1:") or None, int(declared[1]) if declared else None, block[stop + 4 :]))
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """file, offset, record_type, page_id, target_uri, refers_to, declared_digest, declared_bytes (of the HTTP
    header) and payload of every record on the chains of the files in a folder."""
    bound_batches(spark)
    scan = spark.read.option("lineSep", MAGIC).text(path)
    cut = scan.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"), F.col("value").cast("binary").alias("raw"))
    pieces = stage(cut.mapInArrow(_pieces, "file string, part bigint, seq bigint, local bigint, size bigint, span bigint, raw binary"), "pieces")
    parts = pieces.groupBy("file", "part").agg(F.sum(F.col("size") + len(MAGIC)).alias("bytes"))
    parts = parts.selectExpr("file", "part", "coalesce(sum(bytes) over (partition by file order by part rows between unbounded preceding and 1 preceding), 0) base")
    slim = pieces.drop("raw").join(parts, ["file", "part"]).select("file", "part", "seq", (F.col("base") + F.col("local") - len(MAGIC)).alias("pos"), "size", "span")
    chain = stage(_on_chain(slim), "chain")
    # Whole records are nearly all; the lists that differ from that are short in sound archives.
    fakes = chain.where("not real or not whole").select("file", "part", "seq")
    few = fakes.count() <= BROADCAST_PIECES
    hint = F.broadcast if few else lambda x: x
    offsets = parts.select("file", "part", "base")
    small = offsets.count() <= BROADCAST_PIECES
    alone = pieces.join(hint(fakes), ["file", "part", "seq"], "left_anti").join(F.broadcast(offsets) if small else offsets, ["file", "part"])
    alone = alone.select("file", (F.col("base") + F.col("local") - len(MAGIC)).alias("pos"), "raw")
    torn = chain.where("owner is not null and not (real and whole)").select("file", "part", "seq", "pos", "owner")
    torn = pieces.join(hint(torn), ["file", "part", "seq"]).select("file", "owner", "pos", "raw")
    # a piece that looks whole may lie inside a torn record too
    glued = torn.groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("pos", "raw"))).alias("all"))
    joined = F.unhex(F.array_join(F.transform("all", lambda x: F.hex(x["raw"])), MAGIC.encode().hex()))
    glued = glued.select("file", F.col("owner").alias("pos"), joined.alias("raw"))
    return alone.union(glued).mapInArrow(_parsed, "file string, offset bigint, record_type string, page_id bigint, target_uri string, refers_to bigint, declared_digest string, declared_bytes bigint, payload binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: pages written as WARC and read back."""
    path = new_path(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    found, again = read_warc(spark, path), F.col("record_type") == "revisit"
    return found.select(
        "page_id",
        F.when(again, F.col("declared_bytes")).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(again, F.col("declared_digest")).otherwise(F.sha1("payload")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


ORACLE_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY digest, n) AS top FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest, CASE WHEN n >= 1000 AND top IS NOT NULL AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND top IS NOT NULL AND page_id IS DISTINCT FROM top THEN top END AS refers_to FROM g
"""
