"""Operator 9: URL filter over a memory-mapped sorted digest array.

A list of entries (host, path prefix, verdict) becomes one artefact in the
shared folder: the sorted 64-bit xxhash keys of ``host + path``, and the full
strings beside them.  A task maps the arrays (it copies them to its own
temporary folder first when the shared folder is not a mounted path), hashes
every host suffix and path prefix that can be on the list, probes all of them
with one vectorised binary search, and compares the stored full string of every
equal key, so a digest collision never decides.  Pages are only read and
projected: there is no shuffle, and a hot host costs nothing.

An entry fits its host and all subdomains, and URLs whose path starts with its
path.  The block list is an input: host names, or a DataFrame whose ``host`` column
holds them, read on the driver (about 200 bytes a host).  Hosts are lower-cased;
null and empty ones are dropped.  The default list is the file
``blocked_hosts.txt``.
Rules come before the plain block list; among entries of a kind the
longest (host and path together, then host) wins, and of two equal entries the
blocking one.  A URL on neither is allowed.

Defined results: host and path of a null URL, and of one without ``://``, are
empty; the empty URL and rows that repeat are judged like any other; an empty
table gives an empty table; other columns are never read.
"""

from __future__ import annotations

import atexit
import os
import shutil
import string
import tempfile
from functools import lru_cache
from importlib import resources

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelfold.llm.common import filesystem, shared_folder

# The rules of the contract as (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: The default block list, a file of host names beside this module; the SQL is made from it too.
BLOCK_LIST = resources.files(__package__).joinpath("blocked_hosts.txt")
BLOCKED_HOSTS = tuple(x for x in BLOCK_LIST.read_text().split("\n") if x and not x.startswith("#"))

ARRAYS = ("keys.npy", "bounds.npy", "host_len.npy", "kind.npy", "text.npy", "path_lengths.npy")
#: kind: block list, rule that allows, rule that blocks.
LISTED, ALLOW, BLOCK = 0, 1, 2


def host_of(url: str) -> Column:
    host = F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_hosts(blocked, host_col: str = "host") -> list[str]:
    """The different hosts of a block list: names, or a DataFrame with a column of them."""
    if isinstance(blocked, DataFrame):
        host = F.translate(F.col(host_col).cast("string"), string.ascii_uppercase, string.ascii_lowercase).alias("host")
        rows = blocked.select(host).filter("host <> ''").distinct().orderBy("host")
        return [r.host for r in rows.toLocalIterator()]
    lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    return sorted({h.translate(lower) for h in blocked if h})


def build_list(spark: SparkSession, rules=RULES, blocked=BLOCKED_HOSTS) -> str:
    """Write the sorted digest array into the shared folder; returns its location."""
    entries = [(h, p, ALLOW if v == "allow" else BLOCK) for v, h, p in rules] + [(h, "", LISTED) for h in listed_hosts(blocked)]
    entries = sorted(((xxhash.xxh64_intdigest((h + p).encode()), h, p, k) for h, p, k in set(entries)))
    raw = [(h + p).encode() for _, h, p, _ in entries]
    arrays = {
        "keys.npy": np.array([e[0] for e in entries], dtype=np.uint64),
        "bounds.npy": np.cumsum([0] + [len(r) for r in raw], dtype=np.int64),
        "host_len.npy": np.array([len(e[1].encode()) for e in entries], dtype=np.int32),
        "kind.npy": np.array([e[3] for e in entries], dtype=np.int8),
        "text.npy": np.frombuffer(b"".join(raw) or b"\0", dtype=np.uint8),
        # path lengths that occur, in code points: only those prefixes are probed
        "path_lengths.npy": np.array(sorted({len(e[2]) for e in entries}), dtype=np.int64),
    }
    at = shared_folder(spark, "url-digests")
    fs, path = filesystem(at)
    fs.create_dir(path, recursive=True)
    for name, a in arrays.items():
        with fs.open_output_stream(f"{path}/{name}") as f:
            np.save(_Writer(f), a, allow_pickle=False)
    return at


class _Writer:
    """What np.save needs of a file, over an Arrow stream."""

    def __init__(self, f):
        self.write = f.write


@lru_cache(maxsize=2)
def _mapped(at: str) -> dict[str, np.ndarray]:
    from pyarrow.fs import LocalFileSystem

    fs, path = filesystem(at)
    if not isinstance(fs, LocalFileSystem):
        own = tempfile.mkdtemp(prefix="url-digests-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        for name in ARRAYS:
            with fs.open_input_stream(f"{path}/{name}") as src, open(os.path.join(own, name), "wb") as dst:
                while chunk := src.read(1 << 20):
                    dst.write(chunk)
        path = own
    out = {name[:-4]: np.load(os.path.join(path, name), mmap_mode="r", allow_pickle=False) for name in ARRAYS}
    return out


def probe(at: str, hosts, paths) -> tuple[list, list]:
    """(rule or None, verdict) of each URL."""
    a = _mapped(at)
    n = len(hosts)
    rule, verdict = [None] * n, ["allow"] * n
    best = [(-1, -1, -1, -1)] * n
    rows, names, host_lens = [], [], []
    for i, (host, path) in enumerate(zip(hosts, paths)):
        start = 0
        while True:
            suffix = host[start:]
            for k in a["path_lengths"]:
                if k <= len(path):
                    rows.append(i)
                    names.append((suffix + path[:k]).encode())
                    host_lens.append(len(suffix.encode()))
            dot = host.find(".", start)
            if dot < 0:
                break
            start = dot + 1
    if not rows or not len(a["keys"]):
        return rule, verdict
    digests = np.fromiter((xxhash.xxh64_intdigest(x) for x in names), dtype=np.uint64, count=len(names))
    low = np.searchsorted(a["keys"], digests, side="left")
    high = np.searchsorted(a["keys"], digests, side="right")
    for c in np.flatnonzero(low < high):
        for e in range(low[c], high[c]):
            if a["host_len"][e] != host_lens[c] or bytes(a["text"][a["bounds"][e]:a["bounds"][e + 1]]) != names[c]:
                continue
            kind, i = int(a["kind"][e]), rows[c]
            text = names[c].decode()
            rank = (kind != LISTED, len(text), host_lens[c], kind)
            if rank > best[i]:
                best[i] = rank
                rule[i] = text if kind != LISTED else None
                verdict[i] = "allow" if kind == ALLOW else "block"
    return rule, verdict


def _judge(at: str, id_col: str):
    def run(batches):
        for df in batches:
            rule, verdict = probe(at, df["host"].tolist(), df["path"].tolist())
            yield pd.DataFrame({id_col: df[id_col], "host": df["host"], "path": df["path"],
                                "rule": pd.Series(rule, dtype=object), "verdict": verdict})
    return run


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                rules=RULES, blocked=BLOCKED_HOSTS) -> DataFrame:
    """One row per page: id, host, path, rule, verdict; blocked is a block list as listed_hosts reads it."""
    at = build_list(pages.sparkSession, rules, blocked)
    urls = pages.select(F.col(id_col), host_of(url_col).alias("host"), path_of(url_col).alias("path"))
    return urls.mapInPandas(_judge(at, id_col), f"{id_col} {urls.schema[id_col].dataType.simpleString()}, "
                            "host string, path string, rule string, verdict string")


URL_FILTER_SQL = r"""
WITH listed(name) AS (VALUES {hosts}),
u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM u)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
  WHEN rule IS NOT NULL THEN 'block'
  WHEN EXISTS (SELECT 1 FROM listed WHERE host = name OR ends_with(host, '.' || name)) THEN 'block'
  ELSE 'allow' END AS verdict
FROM r
""".replace("{hosts}", ", ".join(f"('{h}')" for h in BLOCKED_HOSTS))
