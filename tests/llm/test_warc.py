import hashlib
from collections import defaultdict

from labelfold.llm import warc as w


def brute(rows):
    groups = defaultdict(list)
    for i, html in rows:
        groups[html or ""].append(i)
    out = []
    for html, ids in groups.items():
        raw = html.encode()
        known = [i for i in ids if i is not None]
        top = max(known) if known else None
        for i in ids:
            again = len(raw) >= 1000 and i != top
            out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response",
                        top if again else None))
    return sorted(out, key=repr)


def test_round_trip_against_brute_force(odd_pages):
    got = sorted(map(tuple, w.warc_round_trip(odd_pages).collect()), key=repr)
    assert got == brute([(r.page_id, r.html) for r in odd_pages.collect()])
    assert w.warc_round_trip(odd_pages.limit(0)).count() == 0


def test_random_access_through_the_seek_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    at, index = w.write_warc(pages, frame_bytes=20_000, bundle_bytes=10_000)
    html = {r.page_id: (r.url, r.html or "") for r in pages.collect()}
    rows = index.collect()
    assert sorted(r.page_id for r in rows) == sorted(html) and len({r.bundle for r in rows}) > 1
    for r in rows[::7]:
        rec = w.read_record(at, r.bundle, r.frame, r.at, r.length)
        assert rec["page_id"] == r.page_id and rec["url"] == html[r.page_id][0]
        if rec["record_type"] == "response":
            assert rec["payload"].decode() == html[r.page_id][1]
    bundle = rows[0].bundle
    frames = w.seek_table(at, bundle)
    assert len(frames) == 1 + max(r.frame for r in rows if r.bundle == bundle)


def test_a_bundle_is_plain_zstandard(spark):
    """The skippable seek table doesn't trouble an ordinary decoder."""
    import zstandard
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(5)
    at, index = w.write_warc(pages, frame_bytes=5_000)
    fs, path = w.filesystem(at)
    bundle = index.first().bundle
    raw = fs.open_input_file(f"{path}/{bundle}").read()
    out, d = b"", zstandard.ZstdDecompressor()
    for start, packed, size in w.seek_table(at, bundle):
        part = d.decompress(raw[start:start + packed])
        assert len(part) == size
        out += part
    assert out.startswith(b"WARC/1.1\r\n")


def test_header_fields_survive():
    raw = w.record_bytes(5, "http://x/%0A\r\n é", b"abc", None, False)
    r = w.parse_record(raw)
    assert (r["page_id"], r["url"], r["payload"]) == (5, "http://x/%0A\r\n é", b"abc")
    r = w.parse_record(w.record_bytes(None, None, b"abc", 9, True))
    assert (r["page_id"], r["url"], r["refers_to"], r["payload"], r["record_type"]) == (None, None, 9, None, "revisit")


def test_urls_stand_in_the_archive_as_given():
    for url in ("http://a.net/a%20b?x=%0A%25", "http://a.net/100%", "", " x ", "http://a.net/ü"):
        raw = w.record_bytes(1, url, b"x", None, False)
        assert f"\r\nWARC-Target-URI: {url}\r\n".encode() in raw and w.parse_record(raw)["url"] == url
    for url in ("a\nb%0A", "a\r\nWARC-Type: fake%"):
        raw = w.record_bytes(1, url, b"x", None, False)
        assert w.parse_record(raw)["url"] == url and w.parse_record(raw)["record_type"] == "response"


def test_record_ids(spark):
    """Ids differ but for rows that repeat id and payload of a response; what a revisit names is its response's id."""
    big = "x" * 1500
    rows = [(1, "u", "a"), (1, "u", "b"), (None, "u", "a"), (None, "v", "a"), (2, "u", big), (3, "u", big), (3, "u", big), (None, "u", big)]
    at, index = w.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"))
    heads = []
    for r in index.collect():
        fs, path = w.filesystem(at)
        with fs.open_input_file(f"{path}/{r.bundle}") as f:
            f.seek(r.frame_at)
            raw = w.zstandard.ZstdDecompressor().decompress(f.read(r.frame_size))[r.at:r.at + r.length]
        heads.append(dict(x.split(": ", 1) for x in raw.partition(b"\r\n\r\n")[0].decode().split("\r\n")[1:]))
    ids = [h["WARC-Record-ID"] for h in heads]
    assert len(ids) == len(rows) and len(set(ids)) == len(rows) - 1  # page 3 stands there twice
    response = {h["WARC-Record-ID"] for h in heads if h["WARC-Type"] == "response"}
    named = [h["WARC-Refers-To"] for h in heads if h["WARC-Type"] == "revisit"]
    assert len(named) == 2 and set(named) <= response
    assert len(set(ids) - response) == 2
