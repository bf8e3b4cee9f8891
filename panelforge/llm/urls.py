"""URL filters over a sorted digest array.

Rules and block-list entries are host and path prefixes, written ``host/path``. Their 64-bit xxHash
digests are sorted into one file together with the full strings; the driver writes the file once, Spark
hands it to the executors, and each worker maps it into memory, so that workers of a machine share it.
A URL is probed by every suffix of its host with every path prefix of a length that some entry has:
one vectorised binary search per batch, and a comparison with the stored string wherever a digest
matches, as two strings may share one.
"""

from __future__ import annotations

import os
import struct
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ALLOW, BLOCK, LISTED = 0, 1, 2
#: Entries a file may hold: its size is bounded by them and by MAX_BYTES of strings, and is checked.
MAX_ENTRIES, MAX_BYTES = 1 << 26, 1 << 32
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# The rules of the query and the hosts its block list names.
RULES = [("org/", ALLOW), ("example.org/es/", BLOCK), ("example.org/en/1", BLOCK), ("com/fr/", ALLOW), ("com/de/", BLOCK)]
HOSTS = [f"{name}.example.{top}" for name in ("ads-track", "spam-farm", "casino-win", "adult-x", "cheap-pills", "free-bets")
         for top in ("com", "net", "org")]


def digest(key: str) -> int:
    return xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass"))


def write_array(entries: Iterable[tuple[str, int]], path: str) -> None:
    """Header, sorted digests, ends of the strings, kinds, path lengths, strings. Repeats count once."""
    rows = sorted({(digest(key), key, kind) for key, kind in entries})
    blobs = [key.encode("utf-8", "surrogatepass") for _, key, _ in rows]
    if len(rows) > MAX_ENTRIES or sum(map(len, blobs)) > MAX_BYTES:
        raise ValueError(f"{len(rows)} entries are more than a digest file may hold")
    lengths = sorted({len(key) - key.find("/") if "/" in key else 0 for _, key, _ in rows})
    with open(path, "wb") as f:
        f.write(struct.pack("<qq", len(rows), len(lengths)))
        f.write(np.array(lengths, dtype="<i8").tobytes())
        f.write(np.array([d for d, _, _ in rows], dtype="<u8").tobytes())
        f.write(np.cumsum([0, *map(len, blobs)]).astype("<i8").tobytes())
        f.write(np.array([kind for _, _, kind in rows], dtype="u1").tobytes())
        f.write(b"".join(blobs))


class DigestArray:
    """A mapped file of ``write_array``."""

    def __init__(self, path: str):
        raw = np.memmap(path, dtype="u1", mode="r")
        n, m = struct.unpack("<qq", raw[:16].tobytes())
        cut = np.cumsum([16, 8 * m, 8 * n, 8 * (n + 1), n])
        self.lengths = raw[cut[0]:cut[1]].view("<i8").tolist()
        self.keys, self.ends = raw[cut[1]:cut[2]].view("<u8"), raw[cut[2]:cut[3]].view("<i8")
        self.kinds, self.blob = raw[cut[3]:cut[4]], raw[cut[4]:]

    def kinds_of(self, probes: list[str]) -> list[list[int]]:
        """The kinds of the entries equal to each probe."""
        found: list[list[int]] = [[] for _ in probes]
        digests = np.array([digest(p) for p in probes], dtype=np.uint64)
        first, last = np.searchsorted(self.keys, digests, "left"), np.searchsorted(self.keys, digests, "right")
        for i in np.flatnonzero(last > first).tolist():
            key = probes[i].encode("utf-8", "surrogatepass")
            for at in range(int(first[i]), int(last[i])):
                if self.blob[self.ends[at]:self.ends[at + 1]].tobytes() == key:
                    found[i].append(int(self.kinds[at]))
        return found


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for NULL and without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    ends = [i for i in (rest.find("/"), rest.find("?"), rest.find("#")) if i >= 0]
    host = rest[:min(ends, default=len(rest))]
    tail = rest[len(host):]
    ends = [i for i in (tail.find("?"), tail.find("#")) if i >= 0]
    return host.translate(_LOWER), tail[:min(ends, default=len(tail))]


def probes(host: str, path: str, lengths: list[int]) -> list[str]:
    """Every suffix of the host at a dot with every path prefix of the given lengths."""
    if not host:
        return []
    suffixes, at = [host], host.find(".")
    while at >= 0:
        suffixes.append(host[at + 1:])
        at = host.find(".", at + 1)
    return [s + path[:n] for s in suffixes for n in lengths if n <= len(path)]


def publish(spark: SparkSession, entries: Iterable[tuple[str, int]]) -> str:
    """Write the array and hand it to all executors; returns its name."""
    path = os.path.join(tempfile.mkdtemp(prefix="digests-"), f"digests-{uuid.uuid4().hex}.bin")
    write_array(entries, path)
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def verdicts(url: Column, name: str) -> Column:
    """Struct of host, path, rule and verdict of each URL by the published array ``name``."""
    @F.pandas_udf("host string, path string, rule string, verdict string")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        array = DigestArray(SparkFiles.get(name))
        for s in batches:
            parts = [split_url(u) for u in s]
            asked = [probes(h, p, array.lengths) for h, p in parts]
            number: dict[str, int] = {}
            for a in asked:
                for p in a:
                    number.setdefault(p, len(number))
            found = array.kinds_of(list(number))
            rows = []
            for (host, path), a in zip(parts, asked):
                hit = [(len(p), p, kinds) for p in a if (kinds := found[number[p]])]
                rules = [(n, p, k) for n, p, kinds in hit for k in kinds if k != LISTED]
                best = max(rules, default=None)  # of equal keys, block
                if best:
                    rows.append((host, path, best[1], "block" if best[2] == BLOCK else "allow"))
                else:
                    rows.append((host, path, None, "block" if any(LISTED in kinds for _, _, kinds in hit) else "allow"))
            yield pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"])

    return udf.asNondeterministic()(url)


def judge(pages: DataFrame, rules: list[tuple[str, int]] = RULES, listed: Iterable[str] = HOSTS) -> DataFrame:
    """``pages`` with a struct ``filter``: host, path, rule and verdict.

    The longest fitting rule decides; without one, a URL whose host (or host and path prefix) is listed
    is blocked and others are allowed. A rule or entry with a path fits only URLs with a path. NULL URLs
    and such without ``://`` have no host, fit nothing and are allowed. Every row stays; a column named
    ``filter`` is replaced, others pass through.
    """
    name = publish(pages.sparkSession, [*rules, *((h, LISTED) for h in listed)])
    return pages.drop("filter").withColumn("filter", verdicts(F.col("url"), name))


ORACLE = f"""
WITH rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
host AS (SELECT page_id, r, regexp_extract(r, '^[^/?#]*') AS h FROM rest),
part AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substr(r, length(h) + 1), '^[^?#]*') AS path FROM host),
rules(rule, what) AS (VALUES {', '.join(f"('{k}', '{'block' if v else 'allow'}')" for k, v in RULES)}),
listed(bad) AS (VALUES {', '.join(f"('{h}')" for h in HOSTS)}),
fits AS (SELECT page_id, host, path, rule, what FROM part LEFT JOIN rules
         ON (host = split_part(rule, '/', 1) OR suffix(host, '.' || split_part(rule, '/', 1)))
         AND prefix(path, substr(rule, strpos(rule, '/')))),
best AS (SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(what, length(rule)) AS what
         FROM fits GROUP BY page_id, host, path)
SELECT page_id, host, path, rule,
       coalesce(what, CASE WHEN EXISTS (SELECT 1 FROM listed WHERE host = bad OR suffix(host, '.' || bad))
                           THEN 'block' ELSE 'allow' END) AS verdict
FROM best
"""
