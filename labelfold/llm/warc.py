"""Operator 7: WARC archives as seekable Zstandard bundles.

Each task writes its pages as WARC/1.1 records into a bundle of its own: records
are grouped into independent Zstandard frames of about ``frame_bytes``, and the
bundle ends in a seek table (a skippable frame: compressed and raw size of every
frame, then the table's footer), so any frame opens alone.  The index maps every
record to its bundle, frame, and offset and length inside the raw frame.

Of pages with equal payloads of at least ``min_revisit`` bytes the largest id is
the response and the others are revisits that name it; payloads are compared by
SHA-256 and length (SHA-1 pairs that collide are known), the digest of the records is SHA-1.  The choice combines on the map side, so a payload that a
third of all pages share is one row per scan task.

A task that is lost or run twice writes another bundle under a fresh name; only
bundles in the index, which Spark commits with the tasks that succeeded, are
ever read.  The read path takes a frame's place from the index, one request a frame; the
footer's seek table gives the same places to readers without the index (``read_record``).

A URL stands in its header as given.  One with a line break, which a header can't hold, is
percent-encoded whole (percent signs and line breaks) and marked by ``WARC-X-URI-Encoded``.

A record's id is its page's id and payload digest; records that nothing refers to (revisits, pages without
an id) carry their place too.  So only pages that repeat both id and payload of a response share an id,
and what refers to it finds the same payload in each.

Defined results: a null html is an empty payload; a null id or URL leaves its
header out and reads back as null; null ids sort before all others; pages that
repeat the largest id of a group are all responses; an empty table gives no
record; a very long payload is a frame of its own; other columns are never read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelfold.llm.common import filesystem, shared_folder, text_of, through_table

# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

INDEX = ("page_id long, bundle string, frame long, frame_at long, frame_size long, "
         "at long, length long")
RECORD = ("page_id long, url string, record_type string, refers_to long, payload binary, digest string")


def record_name(page_id, payload: bytes, place: str = "") -> str:
    """A record's id: the page's id and its payload's SHA-256, which a revisit can tell of its response too, and
    the place of records that nothing refers to."""
    page = "" if page_id is None else page_id
    return f"<urn:page:{page}:{hashlib.sha256(payload).hexdigest()}{place and ':' + place}>"


def record_bytes(page_id, url, payload: bytes, refers_to, revisit: bool, place: str = "") -> bytes:
    """``place`` (bundle and number in it) tells records without a page id, and revisits, apart."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            "WARC-Record-ID: " + record_name(page_id, payload, place if revisit or page_id is None else ""),
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        if "\r" in url or "\n" in url:
            url = url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
            head.append("WARC-X-URI-Encoded: yes")
        head.append("WARC-Target-URI: " + url)
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 "WARC-Refers-To: " + record_name(refers_to, payload)]
        payload = b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    f = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    page = lambda v: (v or "<urn:page::>").split(":")[2]
    number = lambda v: int(page(v)) if page(v) else None
    url = f.get("WARC-Target-URI")
    if url is not None and "WARC-X-URI-Encoded" in f:
        url = url.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")
    payload = rest[:int(f["Content-Length"])]
    if rest[len(payload):] != b"\r\n\r\n":
        raise ValueError("a record doesn't end where its length says")
    digest = base64.b32decode(f["WARC-Payload-Digest"][len("sha1:"):]).hex()
    revisit = f["WARC-Type"] == "revisit"
    if not revisit and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError("a payload doesn't have its digest")
    return {"page_id": number(f["WARC-Record-ID"]), "url": url, "record_type": f["WARC-Type"],
            "refers_to": number(f.get("WARC-Refers-To")), "payload": None if revisit else payload, "digest": digest}


class BundleWriter:
    """Independent frames, then the seek table.  Holds one raw frame at a time."""

    def __init__(self, at: str, frame_bytes: int):
        fs, path = filesystem(at)
        self.name, self.frame_bytes = f"bundle-{uuid.uuid4().hex}.warc.zst", frame_bytes
        self.f = fs.open_output_stream(f"{path}/{self.name}", compression=None)
        self.z = zstandard.ZstdCompressor(level=3)
        self.frames, self.at, self.raw, self.size, self.open = [], 0, [], 0, []
        self.records = 0

    def place(self) -> str:
        """Where the next record will stand, as its id tells it."""
        self.records += 1
        return f"{self.name[len('bundle-'):-len('.warc.zst')]}.{self.records}"

    def add(self, page_id, raw: bytes) -> list[tuple]:
        self.open.append((page_id, self.size, len(raw)))
        self.raw.append(raw)
        self.size += len(raw)
        return self.flush() if self.size >= self.frame_bytes else []

    def flush(self) -> list[tuple]:
        if not self.open:
            return []
        packed = self.z.compress(b"".join(self.raw))
        self.f.write(packed)
        rows = [(p, self.name, len(self.frames), self.at, len(packed), o, n) for p, o, n in self.open]
        self.frames.append((len(packed), self.size))
        self.at += len(packed)
        self.raw, self.size, self.open = [], 0, []
        return rows

    def close(self) -> list[tuple]:
        rows = self.flush()
        table = b"".join(struct.pack("<II", c, r) for c, r in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.f.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.f.close()
        return rows


def seek_table(at: str, bundle: str) -> list[tuple[int, int, int]]:
    """(offset, compressed size, raw size) of every frame, from the footer alone."""
    fs, path = filesystem(at)
    with fs.open_input_file(f"{path}/{bundle}") as f:
        end = f.size()
        f.seek(end - 9)
        n, _, magic = struct.unpack("<IBI", f.read(9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("no seek table")
        f.seek(end - 9 - 8 * n)
        sizes = struct.iter_unpack("<II", f.read(8 * n))
        out, start = [], 0
        for packed, raw in sizes:
            out.append((start, packed, raw))
            start += packed
        return out


def read_record(at: str, bundle: str, frame: int, offset: int, length: int) -> dict:
    """Random access: one record through the seek table and its frame-relative offset."""
    start, packed, _ = seek_table(at, bundle)[frame]
    fs, path = filesystem(at)
    with fs.open_input_file(f"{path}/{bundle}") as f:
        f.seek(start)
        raw = zstandard.ZstdDecompressor().decompress(f.read(packed))
    return parse_record(raw[offset:offset + length])


def _write(at: str, frame_bytes: int, bundle_bytes: int):
    columns = [x.split(" ")[0] for x in INDEX.split(", ")]

    def run(batches):
        out = None
        for df in batches:
            rows = []
            for r in df.itertuples(index=False):
                if out is None:
                    out = BundleWriter(at, frame_bytes)
                page, keep = (None if pd.isna(x) else int(x) for x in (r.page_id, r.refers_to))
                rows += out.add(page, record_bytes(page, r.url, r.html.encode(), keep, r.revisit, out.place()))
                if out.at >= bundle_bytes:
                    rows += out.close()
                    out = None
            yield pd.DataFrame(rows, columns=columns).astype({"page_id": "Int64"})
        if out is not None:
            yield pd.DataFrame(out.close(), columns=columns).astype({"page_id": "Int64"})
    return run


def _read(at: str):
    columns = [x.split(" ")[0] for x in RECORD.split(", ")]

    def run(batches):
        fs, path = filesystem(at)
        unpack = zstandard.ZstdDecompressor()
        for df in batches:
            for r in df.itertuples(index=False):
                with fs.open_input_file(f"{path}/{r.bundle}") as f:
                    f.seek(r.frame_at)
                    raw = unpack.decompress(f.read(r.frame_size))
                rows = [parse_record(raw[o:o + n]) for o, n in zip(r.at, r.length)]
                yield pd.DataFrame(rows, columns=columns).astype({"page_id": "Int64", "refers_to": "Int64"})
    return run


def write_warc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               min_revisit: int = 1000, frame_bytes: int = 1 << 20,
               bundle_bytes: int = 1 << 28) -> tuple[str, DataFrame]:
    """Write the bundles; returns their folder and the record index."""
    spark = pages.sparkSession
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                     text_of(html_col).alias("html"))
    key = [F.unhex(F.sha2("html", 256)).alias("sha"), F.octet_length("html").alias("n")]
    # written, so that the join below meets it by a plain exchange, which can be split at a hot payload
    best = through_table(
        p.select("page_id", *key).filter(F.col("n") >= min_revisit).groupBy("sha", "n")
        .agg(F.max("page_id").alias("keep"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1").select("sha", "n", "keep"), "warc-best")
    # only ids and digests meet the choice; pages get theirs by id, so no hot payload is shuffled
    revisits = (p.select("page_id", *key).join(best, ["sha", "n"])
                .filter("page_id is null or page_id < keep")
                .select(F.col("page_id").alias("rid"), F.col("sha").alias("rsha"), "keep").distinct())
    marked = (p.join(revisits, F.col("page_id").eqNullSafe(F.col("rid"))
                     & (F.unhex(F.sha2("html", 256)) == F.col("rsha")), "left")
              .select("page_id", "url", "html", F.col("keep").alias("refers_to"),
                      F.col("keep").isNotNull().alias("revisit")))
    at = shared_folder(spark, "warc")
    fs, path = filesystem(at)
    fs.create_dir(path, recursive=True)
    return at, through_table(marked.mapInPandas(_write(at, frame_bytes, bundle_bytes), INDEX), "warc-index")


def read_warc(at: str, index: DataFrame) -> DataFrame:
    """All records of the indexed bundles, one task row per frame."""
    frames = (index.groupBy("bundle", "frame", "frame_at", "frame_size")
              .agg(F.sort_array(F.collect_list(F.struct("at", "length"))).alias("r"))
              .select("bundle", "frame_at", "frame_size", F.col("r.at").alias("at"),
                      F.col("r.length").alias("length")))
    return frames.mapInPandas(_read(at), RECORD)


def warc_round_trip(pages: DataFrame, id_col: str = "page_id", **options) -> DataFrame:
    """One row per page, from the archives: id, payload_bytes, payload_digest, record_type, refers_to."""
    at, index = write_warc(pages, id_col, **options)
    read = through_table(read_warc(at, index).select(
        "page_id", "record_type", "refers_to", "digest", F.octet_length("payload").cast("long").alias("bytes")),
        "warc-read")
    # a revisit has no payload of its own: its length is that of the response it names
    held = through_table(read.filter("record_type = 'response'").groupBy(
        F.col("page_id").alias("rid"), F.col("digest").alias("rdigest")).agg(F.max("bytes").alias("held")), "warc-held")
    return (read.join(held, (F.col("refers_to") == F.col("rid")) & (F.col("digest") == F.col("rdigest")), "left")
            .select(F.col("page_id").alias(id_col), F.coalesce("bytes", "held").alias("payload_bytes"),
                    F.col("digest").alias("payload_digest"), "record_type", "refers_to"))


WARC_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY d, n) AS top FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM m
"""
