"""WARC archives: writing pages as records, and reading records back by boundary chains.

Writing: a payload is stored once. Of equal payloads the record of the smallest page id is a
response, the others are revisits that refer to it. Records are written by Spark's text writer, whose
line separator is the blank line that ends a record.

Reading: archives are read in splits, cut at each place where a record could begin (the version line,
also inside payloads). For each candidate a task emits its offset and the offset of its successor, by
the length that its header states. Chains are first shortened inside regions of a file; pointer jumping
from the start of each file, doubling the reach in every round, then tells where chains enter the
regions, and the candidates on the chains from there are kept. All others are payload that looks like
a record, and go back to the record whose payload they are. A split knows how long its
parts are but not where it starts; the lengths of the splits before it tell.

A null page is an empty payload; a null id or URL has no header of its own. Control characters in URLs
and ids are escaped. The date of the records is an argument, so that reruns agree. Repeated rows are records of their own, the first in order (by URL, then count) being
the response. Long payloads are single records; an empty table gives no record. Other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewarden.functions.times import Instant, instant, iso_text
from tidewarden.llm.common import ship_package, written
from tidewarden.session import shared_folder

#: Bytes of a file whose links are followed in one task.
REGION = 8 << 20
#: The start of a record, and what ends it.
VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
CONTROL = "[\\x00-\\x1f\\x7f]"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# Fixed by the standard.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of bytes in base 32: four letters for each five hex digits."""
    digest = F.sha1(payload)
    letters = []
    for i in range(8):
        bits = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.substr(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(31) + 1,
                                    F.lit(1)))
    return F.concat(*letters)


def _header(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")


def _payloads(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """Payloads with their digest and length; ``named`` is what orders equal ones."""
    found = pages.select(
        F.struct(F.col(page_id).isNull().alias("none"), F.col(page_id).alias("page"),
                 F.coalesce(F.col(url), F.lit("")).alias("url")).alias("named"),
        F.coalesce(F.col(html), F.lit("")).alias("html"))
    return found.select("*", base32_sha1(F.col("html").cast("binary")).alias("digest"),
                        F.octet_length("html").cast("long").alias("bytes"))


def shared_payloads(pages: DataFrame, least_bytes: int = 0, page_id: str = "page_id",
                    url: str = "url", html: str = "html") -> DataFrame:
    """Columns digest, first and times of payloads that several rows hold: the first of these rows,
    and how many rows equal it."""
    rows = _payloads(pages, page_id, url, html).filter(F.col("bytes") >= least_bytes).groupBy(
        "digest", "named").agg(F.count("*").alias("times"))
    return rows.groupBy("digest").agg(
        F.min(F.struct("named", "times")).alias("least"), F.sum("times").alias("all")).filter(
        "all > 1").select("digest", F.col("least.named").alias("first"), "least.times")


def _urn(digest: Column, named: Column) -> Column:
    """A name for a response, the same wherever it is worked out."""
    name = F.md5(F.to_json(F.struct(digest.alias("digest"), named.alias("named"))))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(
        name, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _line(text: Column, unsafe: str) -> Column:
    """Text as a header's value, which is one line."""
    return F.nullif(F.regexp_replace(text, unsafe, "%20"), F.lit(""))


def records(pages: DataFrame, least_bytes: int = 0, page_id: str = "page_id", url: str = "url",
            html: str = "html", date: Instant = None) -> DataFrame:
    """A column ``value``: a record for each page, without its END; ``date`` is when the pages were
    fetched, by default now."""
    shared = written(shared_payloads(pages, least_bytes, page_id, url, html), "shared-payloads")
    # Rows that repeat the response's are taken once and counted out again.
    again = written(shared.filter("times > 1"), "repeated-pages")
    once = _payloads(pages, page_id, url, html).join(shared, "digest", "left")
    single = once.filter("times IS NULL OR times = 1 OR named <> first").withColumn(
        "is_response", F.col("times").isNull() | (F.col("named") == F.col("first")))
    several = _payloads(pages, page_id, url, html).join(again, "digest").filter(
        "named = first").dropDuplicates(["digest"]).withColumn(
        "is_response", F.explode(F.transform(F.sequence(F.lit(1), F.col("times").cast("int")),
                                             lambda i: i == 1)))
    typed = single.unionByName(several)
    number = F.col("bytes").cast("string")

    body = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
                    F.lit("Content-Length: "), number, F.lit(END),
                    F.when(F.col("is_response"), F.col("html")).otherwise(""))
    headers = F.concat(
        F.lit(VERSION), F.lit("WARC-Type: "),
        F.when(F.col("is_response"), "response").otherwise("revisit"), F.lit("\r\n"),
        # Nothing refers to a revisit; any name of its own will do.
        _header("WARC-Record-ID", F.when(F.col("is_response"), _urn(F.col("digest"), F.col("named")))
                .otherwise(F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")))),
        _header("WARC-Date", iso_text(instant(date))),
        _header("WARC-Target-URI", _line(F.col("named.url"), "[\\x00-\\x20\\x7f]")),
        _header("X-Page-ID", _line(F.col("named.page").cast("string"), CONTROL)),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("X-Payload-Length", number),
        F.when(F.col("is_response"), "").otherwise(F.concat(
            F.lit(f"WARC-Profile: {PROFILE}\r\n"), _header(
                "WARC-Refers-To", _urn(F.col("digest"), F.col("first"))),
            _header("X-Refers-To-Page", _line(F.col("first.page").cast("string"), CONTROL)))))
    return typed.select(body.alias("body"), headers.alias("headers")).select(F.concat(
        "headers", F.lit("Content-Length: "), F.octet_length("body").cast("string"), F.lit(END),
        "body").alias("value"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, page_id: str = "page_id",
                   url: str = "url", html: str = "html", records_per_file: int = 50_000,
                   date: Instant = None) -> None:
    """Archives below ``folder``, each of at most ``records_per_file`` records."""
    records(pages, least_bytes, page_id, url, html, date).write.option("lineSep", END).option(
        "maxRecordsPerFile", records_per_file).text(folder)


def _parts(spark: SparkSession, folder: str) -> DataFrame:
    """What lies between version lines: file, block (the split's start) and value. What precedes
    the first version line of a file is a part too, normally an empty one."""
    return spark.read.option("lineSep", VERSION).text(folder).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"))


def _placed(batch: pa.RecordBatch, state: dict) -> Iterator[tuple[str, int, int, bytes]]:
    """A batch's parts with their place, the bytes since the first part of their split."""
    for file, block, value in zip(*[batch.column(i).to_pylist() for i in range(3)]):
        if state.get("split") != (file, block):
            state.update(split=(file, block), place=0)
        yield file, block, state["place"], value
        state["place"] += len(value) + len(VERSION)


_FIELD = re.compile(rb"([A-Za-z-]+):[ \t]*([^\r\n]*)")


def parse_headers(part: bytes) -> tuple[dict[str, str], int] | None:
    """The named fields of a record's header and its length, or None if it is none."""
    stop = part.find(b"\r\n\r\n")
    if stop < 0:
        return None
    fields = {}
    for line in part[:stop].split(b"\r\n"):
        found = _FIELD.fullmatch(line)
        if not found:
            return None
        fields[found[1].decode().lower()] = found[2].decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit() and len(length) < 19):
        return None
    return fields, stop + 4


def described(part: bytes) -> dict | None:
    """A whole record's columns, of what follows its version line; None if it is none."""
    found = parse_headers(part)
    if found is None:
        return None
    fields, start = found
    block = part[start:start + int(fields["content-length"])]
    payload = block[block.find(b"\r\n\r\n") + 4:] if b"\r\n\r\n" in block else b""
    stored = fields.get("warc-type") != "revisit"
    length = fields.get("x-payload-length", "")
    return {
        "page": fields.get("x-page-id"), "uri": fields.get("warc-target-uri"),
        "record_type": fields.get("warc-type"),
        "payload_bytes": len(payload) if stored else int(length) if length.isdigit() else None,
        "payload_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode() if stored
        else fields.get("warc-payload-digest", "").removeprefix("sha1:"),
        "refers_to": fields.get("x-refers-to-page"), "payload": payload if stored else None}


_COLUMNS = [("page", pa.string()), ("uri", pa.string()), ("record_type", pa.string()),
            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("refers_to", pa.string())]
_RECORD = ("page string, uri string, record_type string, payload_bytes long, "
           "payload_digest string, refers_to string")
_NAMES = [name for name, _ in _COLUMNS]


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each part: file, block, place, size (with the version line that ends it), reach
    (bytes from its start to where, by its header, the next record's part starts; null if it is no
    record), and the columns of the record if the part holds all of it."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for batch in batches:
            rows = []
            for file, block, place, value in _placed(batch, state):
                size, found = len(value) + len(VERSION), parse_headers(value)
                reach = None if found is None else (
                    found[1] + int(found[0]["content-length"]) + len(END) + len(VERSION))
                record = described(value) if reach is not None and reach <= size else None
                rows.append((file, block, place, size, reach,
                             *[record and record[name] for name in _NAMES]))
            columns = list(zip(*rows)) or [()] * (5 + len(_NAMES))
            kinds = [pa.string(), *[pa.int64()] * 4, *[kind for _, kind in _COLUMNS]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)],
                names=["file", "block", "place", "size", "reach", *_NAMES])

    ship_package(spark)
    return _parts(spark, folder).mapInArrow(
        of, f"file string, block long, place long, size long, reach long, {_RECORD}")


def _at(parts: DataFrame) -> DataFrame:
    """The parts with ``at``, where they start in the file (after the version line)."""
    splits = parts.groupBy("file", "block").agg(F.sum("size").alias("total"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file", "block", F.coalesce(F.sum("total").over(before), F.lit(0))
                           .alias("start"))
    return parts.join(starts, ["file", "block"]).withColumn(
        "at", F.col("start") + F.col("place")).drop("start")


def _merged(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join by sorting: these tables compress to little, so their size on disk says nothing about
    what a broadcast of them would be."""
    return left.hint("merge").join(right.hint("merge"), on, how)


def jumped(links: DataFrame) -> DataFrame:
    """Columns file and at: what chains from the start of each file reach, of links (file, at, to).
    In each round the reached hand on to what lies as many records ahead as all rounds before
    together, and every link doubles its length."""
    nodes = links.select("file", "at")
    reached = written(nodes.filter(F.col("at") == len(VERSION)), "reached")
    jumps, count = links, reached.count()
    while count:
        ahead = _merged(reached, jumps, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = written(reached.union(_merged(ahead, nodes, ["file", "at"], "left_semi")).distinct(),
                          "reached")
        before, count = count, reached.count()
        if count == before:
            break
        onward = jumps.select("file", F.col("at").alias("to"), F.col("to").alias("further"))
        jumps = written(_merged(jumps, onward, ["file", "to"]).select(
            "file", "at", F.col("further").alias("to")), "jumps")
    return reached


def _exits(stop: int, nodes: list[dict]) -> Iterator[tuple[int, int | None]]:
    """Of a region's nodes: each with the first place at or after ``stop`` that its chain names, None
    if the chain ends before."""
    found: dict[int, int | None] = {}
    for node in sorted(nodes, key=lambda n: -n["at"]):
        at, to = node["at"], node["to"]
        found[at] = to if to >= stop else found.get(to) if to > at else None
        yield at, found[at]


def _walks(entries: list[int], nodes: list[dict]) -> set[int]:
    """The nodes of a region that chains from its entries pass."""
    onward = {node["at"]: node["to"] for node in nodes}
    passed: set[int] = set()
    for at in entries:
        while at in onward and at not in passed:
            passed.add(at)
            at = onward[at] if onward[at] > at else None
    return passed


def _by_rows(frame: DataFrame, of, schema: str) -> DataFrame:
    """The rows (file, then whole numbers) that ``of`` makes of each row's other columns."""
    kind = frame.schema["file"].dataType.simpleString()
    width = len(schema.split(","))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                file, *rest = (column[i].as_py() for column in batch.columns)
                made = list(of(*rest))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file] * len(made), batch.schema.field(0).type),
                     *[pa.array([row[k] for row in made], pa.int64()) for k in range(width)]],
                    names=["file", *[part.split()[0] for part in schema.split(", ")]])

    ship_package(frame.sparkSession)
    return frame.mapInArrow(run, f"file {kind}, {schema}")


def reachable(links: DataFrame) -> DataFrame:
    """Columns file and at: what chains from the start of each file reach, of links (file, at, to).

    A file's places are cut into regions, a row each with the region's links. A task follows the
    chains of a region to where they leave it; pointers then jump over the places where chains leave and
    enter regions alone, few to a region; and from the places reached a task walks through each region.
    """
    regions = written(links.groupBy("file", F.expr(f"at div {REGION}").alias("region")).agg(
        F.collect_list(F.struct("at", "to")).alias("nodes")), "regions")
    region = REGION  # the driver's value goes to the executors
    exits = written(_by_rows(regions, lambda k, nodes: _exits((k + 1) * region, nodes),
                             "at long, to long"), "exits")
    entries = exits.select("file", F.col("to").alias("at")).filter("at IS NOT NULL").distinct().union(
        exits.filter(F.col("at") == len(VERSION)).select("file", "at")).distinct()
    entered = jumped(written(_merged(exits, entries, ["file", "at"]), "entries"))
    starts = entered.groupBy("file", F.expr(f"at div {REGION}").alias("region")).agg(
        F.collect_list("at").alias("entries"))
    return _by_rows(_merged(regions, starts, ["file", "region"]).select("file", "entries", "nodes"),
                    lambda entries, nodes: ((at,) for at in _walks(entries, nodes)), "at long")


def _reassembled(spark: SparkSession, folder: str, broken: DataFrame) -> DataFrame:
    """Records whose payload holds version lines: their parts are read again and put together.
    ``broken`` has number (of the file), block, place and at of the parts, and the owner. It is small
    unless much of the archive lies in such payloads; Spark checks its size."""
    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for batch in batches:
            columns = list(zip(*_placed(batch, state))) or [()] * 4
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)],
                names=["file", "block", "place", "value"])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [described(VERSION.encode().join(p["value"] for p in parts)) or {}
                    for parts in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *[pa.array([r.get(name) for r in rows], kind)
                                       for name, kind in _COLUMNS]],
                names=["file", "at", *_NAMES])

    values = _parts(spark, folder).mapInArrow(
        again, "file string, block long, place long, value binary")
    # One group is one record, which its reader needs whole.
    numbered = values.withColumn("number", F.xxhash64("file"))
    grouped = numbered.join(broken, ["number", "block", "place"]).groupBy(
        "file", F.col("owner").alias("at")).agg(
        F.sort_array(F.collect_list(F.struct("at", "value"))).alias("parts"))
    return grouped.mapInArrow(describe, f"file string, at long, {_RECORD}")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each record below ``folder``: file, at, page, uri, record_type, payload_bytes,
    payload_digest (both taken from the payload that was read, for revisits from the header) and
    refers_to."""
    parts = written(_at(candidates(spark, folder)), "parts")
    # Chains need no names of files, only to tell them apart.
    links = parts.filter("reach IS NOT NULL").select(
        F.xxhash64("file").alias("file"), "at", (F.col("at") + F.col("reach")).alias("to"))
    starts = reachable(links).select(F.col("file").alias("number"), "at", F.lit(True).alias("starts"))
    marked = _merged(parts.withColumn("number", F.xxhash64("file")), starts, ["number", "at"], "left")
    whole = marked.filter("starts AND size >= reach").select("file", "at", *_NAMES)
    # Other parts are payload of the last record that starts before them.
    so_far = Window.partitionBy("number").orderBy("at")
    own = F.when(F.col("starts"), F.struct("at", "size", "reach"))
    owned = marked.select("number", "block", "place", "at", F.last(own, ignorenulls=True).over(so_far)
                          .alias("own"))
    broken = written(owned.filter("own.size < own.reach AND at < own.at + own.reach").select(
        "number", "block", "place", "at", F.col("own.at").alias("owner")), "broken")
    return whole.unionByName(_reassembled(spark, folder, broken))


def round_trip(pages: DataFrame, least_bytes: int = 0, page_id: str = "page_id", url: str = "url",
               html: str = "html") -> DataFrame:
    """Writes the pages to archives in the shared folder and reads them back."""
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    write_archives(pages, folder, least_bytes, page_id, url, html)
    return read_archives(spark, folder)
