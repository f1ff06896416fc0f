"""WARC archives of Zstandard frames: one per record, after a frame that holds the dictionary."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dualscript.operators.lookup import balanced_lookup
from dualscript.sources.storage import fresh_name, materialise, shared_dir

# --- fixed values: the formats ---
SKIPPABLE = 0x184D2A5D  # magic number of the leading frame that holds a dictionary
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# --- end of fixed values ---

MIN_REVISIT = 1000  # shorter payloads are always stored
ROLL_BYTES = 64 << 20  # an archive is closed beyond this size
DICT_PAGES, DICT_PAGE_BYTES, DICT_BYTES = 400, 32_768, 65_536  # bounds of the dictionary's sample
DATE = "1970-01-01T00:00:00Z"
LEVEL = 3


class WarcError(ValueError):
    """An archive that does not keep the format."""


# ---------------------------------------------------------------- records


def _line(value) -> str:
    """A header value on one line: line breaks become percent escapes."""
    return re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", str(value))


def sha1_of(payload: bytes) -> str:
    return hashlib.sha1(payload).hexdigest()


def _digest_header(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _page_uri(page_id) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC record, ready to be compressed as a frame.

    A revisit holds the HTTP header alone, which still states the payload's length.
    """
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            + b"Content-Length: %d\r\n\r\n" % len(payload))
    block = http if revisit else http + payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Concurrent-To", f"<{_page_uri(page_id)}>"),
        ("WARC-Payload-Digest", _digest_header(digest)),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        head.append(("WARC-Target-URI", _line(url)))
    if revisit:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{_page_uri(refers_to)}>")]
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in head)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise WarcError(f"no header line: {line[:60]!r}")
        out[name.decode("ascii").lower()] = value.strip().decode()
    return out


def _page_id(uri: str) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d*)>", uri)
    if m is None:
        raise WarcError(f"no page: {uri[:60]!r}")
    return int(m[1]) if m[1] else None


def parse(raw: bytes) -> dict:
    """The fields of one record, after its version, headers, lengths and digest are checked."""
    version, _, rest = raw.partition(b"\r\n")
    if version != VERSION:
        raise WarcError(f"no WARC version: {version[:20]!r}")
    head, blank, rest = rest.partition(b"\r\n\r\n")
    if not blank:
        raise WarcError("the header does not end")
    h = _headers(head)
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - h.keys()
    if missing:
        raise WarcError(f"headers are missing: {', '.join(sorted(missing))}")
    if not h["content-length"].isdigit() or int(h["content-length"]) + 4 != len(rest):
        raise WarcError(f"Content-Length {h['content-length']!r}, block of {len(rest) - 4}")
    if rest[-4:] != b"\r\n\r\n":
        raise WarcError("the record does not end with two line breaks")
    http, blank, payload = rest[:-4].partition(b"\r\n\r\n")
    status, _, fields = http.partition(b"\r\n")
    if not blank or not status.startswith(b"HTTP/"):
        raise WarcError("the block is no HTTP response")
    stated = _headers(fields).get("content-length", "")
    if not stated.isdigit():
        raise WarcError("the payload's length is not stated")
    kind = h["warc-type"]
    if kind not in ("response", "revisit"):
        raise WarcError(f"unknown type {kind[:20]!r}")
    named = h.get("warc-payload-digest", "")
    try:
        digest = base64.b32decode(named.removeprefix("sha1:")).hex()
    except ValueError:
        raise WarcError(f"no digest: {named[:60]!r}") from None
    if kind == "response" and (len(payload) != int(stated) or sha1_of(payload) != digest):
        raise WarcError("the payload does not match its length or digest")
    if kind == "revisit" and payload:
        raise WarcError("a revisit holds a payload")
    return {
        "page_id": _page_id(h.get("warc-concurrent-to", "")), "url": h.get("warc-target-uri"),
        "payload_bytes": int(stated), "payload_digest": digest, "record_type": kind,
        "refers_to": _page_id(h.get("warc-refers-to", "")) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


# ---------------------------------------------------------------- archives


def dictionary_frame(dictionary: bytes) -> bytes:
    """The skippable frame that leads an archive; the dictionary is a frame of its own in it."""
    body = zstandard.ZstdCompressor().compress(dictionary)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def leading_dictionary(data: bytes) -> tuple[bytes | None, int]:
    """The dictionary of an archive, if it has one, and where its records begin."""
    if len(data) < 8 or struct.unpack_from("<I", data)[0] != SKIPPABLE:
        return None, 0
    size = struct.unpack_from("<I", data, 4)[0]
    body = data[8:8 + size]
    if len(body) != size:
        raise WarcError("the dictionary's frame is cut short")
    if body[:4] == ZSTD_MAGIC:
        body = zstandard.ZstdDecompressor().decompress(body)
    return body, 8 + size


def read_archive(data: bytes) -> Iterator[dict]:
    """The checked records of an archive; each frame must hold one record and end with it."""
    dictionary, at = leading_dictionary(data)
    extra = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    decompressor, view = zstandard.ZstdDecompressor(**extra), memoryview(data)
    while at < len(data):
        frame = decompressor.decompressobj()
        try:
            raw = frame.decompress(view[at:])
        except zstandard.ZstdError as e:
            raise WarcError(f"frame at byte {at}: {e}") from None
        if not frame.eof:
            raise WarcError(f"the frame at byte {at} is cut short")
        yield parse(raw)
        at = len(data) - len(frame.unused_data)


def train_dictionary(pages: DataFrame, html: str = "html") -> bytes:
    """A dictionary from a bounded sample of shorter pages; empty if there are too few."""
    short = pages.where(F.octet_length(html).between(8, DICT_PAGE_BYTES)).select(F.col(html).alias("h"))
    n = short.count()
    if not n:
        return b""
    slot = F.pmod(F.xxhash64("h"), F.lit(1 << 30))
    rows = short.where(slot < int(min(1.0, DICT_PAGES / n) * (1 << 30))).limit(2 * DICT_PAGES).collect()
    try:
        return zstandard.train_dictionary(DICT_BYTES, [r[0].encode() for r in rows]).as_bytes()
    except zstandard.ZstdError:
        return b""  # too little to learn from


def classified(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """``_id, _url, _html, _digest, _keeper``: the last is the row that holds the payload, if not this one.

    Digests on more than 1 / 1000 of the repeated rows are broadcast, at most
    1000 of them; rows they answer are scattered, so equal pages do not meet.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("_id"), F.col(url).alias("_url"), payload.alias("_html"),
                        F.sha1(payload).alias("_digest"))
    repeated = rows.where(F.octet_length("_html") >= MIN_REVISIT).groupBy("_digest").agg(
        F.count("*").alias("_n"), F.max("_id").alias("_keeper")).where("_n > 1")
    repeated = materialise(repeated, "repeated-payloads")
    found = balanced_lookup(rows, repeated.withColumn("_repeated", F.lit(True)), ["_digest"], "_n", ["_id", "_url"])
    revisit = F.col("_repeated").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_keeper"))
    return found.withColumn("_revisit", revisit)


def _filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if "://" not in uri:
        uri = "file://" + uri.removeprefix("file:")
    return pyarrow.fs.FileSystem.from_uri(uri)


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
                   dictionary: bytes | None = None) -> DataFrame:
    """Write every row of ``pages`` as a record below ``folder``; returns ``path, n_records``.

    The payload is the html in UTF-8, a null one empty.  Of rows with equal
    payloads of at least ``MIN_REVISIT`` bytes those with the largest key are
    responses and the others revisit it; a null key counts as smaller than any.
    An archive gets its name when it is complete and each attempt of a task has
    names of its own: the returned table, not the folder, says what counts.
    """
    if dictionary is None:
        dictionary = train_dictionary(pages, html)
    shared = pages.sparkSession.sparkContext.broadcast(dictionary)  # DICT_BYTES at most

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        extra = {"dict_data": zstandard.ZstdCompressionDict(known)} if known else {}
        compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True, **extra)
        fs, base = _filesystem(folder)
        fs.create_dir(base, recursive=True)
        done, out, size, n, name = [], None, 0, 0, ""

        def close():
            out.close()
            fs.move(f"{base}/.{name}", f"{base}/{name}")
            done.append((name, n))

        try:
            for batch in batches:
                for i, u, h, digest, keeper, revisit in zip(*[batch[c] for c in (
                        "_id", "_url", "_html", "_digest", "_keeper", "_revisit")]):
                    if out is None:
                        name, size, n = f"part-{fresh_name()}.warc.zst", 0, 0
                        out = fs.open_output_stream(f"{base}/.{name}", compression=None)
                        if known:
                            out.write(dictionary_frame(known))
                    i, keeper = (None if pd.isna(v) else int(v) for v in (i, keeper))
                    frame = compressor.compress(record(i, None if pd.isna(u) else u, h.encode(), digest, keeper, bool(revisit)))
                    out.write(frame)
                    size, n = size + len(frame), n + 1
                    if size > ROLL_BYTES:
                        close()
                        out = None
            if out is not None:
                close()
        finally:
            if out is not None and not out.closed:
                out.close()
        yield pd.DataFrame(done, columns=["path", "n_records"])

    written = classified(pages, key, url, html).select("_id", "_url", "_html", "_digest", "_keeper", "_revisit")
    named = written.mapInPandas(write, "path string, n_records long")
    # written once: a later read of the list must not write again
    return materialise(named, "archives").select(F.concat(F.lit(folder.rstrip("/") + "/"), "path").alias("path"), "n_records")


READ = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, payload binary")


def read_archives(spark: SparkSession, archives: DataFrame) -> DataFrame:
    """The checked records of the archives named in ``archives (path, n_records)``.

    Any other number of records, a damaged frame or a header that does not fit
    fails the job.  Archives are read as whole files, of ``ROLL_BYTES`` and a record at most.
    """
    folder = archives.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("f")).distinct().collect()
    if not folder:
        return spark.createDataFrame([], READ)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.warc.zst").load([r["f"] for r in folder])
    name: Column = F.regexp_extract("path", "[^/]*$", 0)
    # of the files only the names in the list: attempts that were lost left others
    listed = archives.select(F.regexp_extract("path", "[^/]*$", 0).alias("_name"), "n_records")
    chosen = files.select(name.alias("_name"), "content").join(listed, "_name").select("content", "n_records")

    def parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content, expected in zip(batch["content"], batch["n_records"]):
                rows, held, seen = [], 0, 0
                for r in read_archive(bytes(content)):
                    rows.append(r)
                    seen, held = seen + 1, held + len(r["payload"] or b"")
                    if held > ROLL_BYTES // 4:
                        yield _frame(rows)
                        rows, held = [], 0
                if seen != expected:
                    raise WarcError(f"{seen} records, {expected} were written")
                yield _frame(rows)

    return chosen.mapInPandas(parsed, READ)


def _frame(rows: list[dict]) -> pd.DataFrame:
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    out = pd.DataFrame(rows, columns=names)
    return out.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write ``pages`` to fresh archives in the shared folder and read their records back.

    Null and empty html give empty payloads, null urls records without one;
    keys may be null or repeat; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    folder = f"{shared_dir(spark)}/warc-{fresh_name()}"
    return read_archives(spark, write_archives(pages, folder, key, url, html))
