"""URL filter rules in a sorted digest array.

A rule is a host and a path prefix.  The rules are one file: the sorted 64-bit digests of their strings, then
offsets and the strings themselves.  Spark hands the file to every executor, tasks map it into memory, so
only the pages that probes touch are read.  A batch of urls is probed by vectorised binary search; a hit counts
once the stored string equals the probed one, so digests that collide do no harm.

Two such arrays are kept: the hosts of rules, each with the lengths of its paths, and the rules.  A url probes
the hosts with every suffix of its host that starts at a label, and the rules with only those path lengths.
Rule lists beyond ``FILE_BYTES`` are not sent out: the same probes meet the rules in keyed joins.
"""

from __future__ import annotations

import mmap
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tissueloom.llm.common import map_texts
from tissueloom.sources.storage import fresh_path

#: Size of rule strings up to which the driver packs them and every executor gets the file, and bytes written by one call.
FILE_BYTES, WRITE_BYTES = 1 << 26, 1 << 24
ALLOW, BLOCK = "allow", "block"
#: Host and path of a url: after the first ``://``.
URL = "(?s)://([^/?#]*)([^?#]*)"


def digest(key: bytes) -> int:
    return xxhash.xxh64_intdigest(key)


class DigestArray:
    """Strings behind their sorted digests, inside one buffer.

    Layout, little-endian 64-bit numbers: count, digests ascending, ``count + 1`` offsets, then the strings in
    that order.  Equal digests stand side by side in any order.
    """

    def __init__(self, buffer, at: int = 0):
        self.buffer = buffer
        n = int(np.frombuffer(buffer, "<u8", 1, at)[0])
        self.digests = np.frombuffer(buffer, "<u8", n, at + 8)
        self.offsets = np.frombuffer(buffer, "<u8", n + 1, at + 8 + 8 * n)
        self.base = at + 16 + 16 * n
        self.end = self.base + int(self.offsets[-1])

    @staticmethod
    def pack(keys: list[bytes], hashed: Callable[[bytes], int] = digest) -> tuple[bytes, np.ndarray]:
        """The buffer of distinct keys, and the order in which they stand in it."""
        digests = np.fromiter(map(hashed, keys), np.uint64, len(keys))
        order = np.argsort(digests, kind="stable")
        sizes = np.fromiter((len(keys[i]) for i in order), np.uint64, len(keys))
        head = [np.array([len(keys)], "<u8"), digests[order].astype("<u8"), np.r_[np.uint64(0), np.cumsum(sizes)].astype("<u8")]
        body = b"".join(keys[i] for i in order)
        return b"".join(x.tobytes() for x in head) + body + bytes(-len(body) % 8), order

    def find(self, keys: list[bytes], hashed: Callable[[bytes], int] = digest) -> np.ndarray:
        """Place of each key in the array, or -1."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self.digests) or not keys:
            return out
        probes = np.fromiter(map(hashed, keys), np.uint64, len(keys))
        first = np.searchsorted(self.digests, probes, "left")
        last = np.searchsorted(self.digests, probes, "right")
        for i in np.flatnonzero(last > first).tolist():
            for k in range(first[i], last[i]):  # one entry, or those of colliding digests
                if self.buffer[self.base + int(self.offsets[k]) : self.base + int(self.offsets[k + 1])] == keys[i]:
                    out[i] = k
                    break
        return out


def suffixes(host: str) -> list[str]:
    """The host and what follows each of its dots: the hosts whose rules may fit it."""
    out = [host]
    at = host.find(".")
    while at >= 0:
        out.append(host[at + 1 :])
        at = host.find(".", at + 1)
    return out


def rule_key(host: str, path: str) -> bytes:
    return f"{len(host)}:{host}{path}".encode()


class Rules:
    """The packed rules: array of hosts with path lengths, array of rules with their verdicts."""

    def __init__(self, buffer):
        self.hosts = DigestArray(buffer)
        at = -(-self.hosts.end // 8) * 8
        n = len(self.hosts.digests)
        self.cuts = np.frombuffer(buffer, "<u8", n + 1, at)
        self.lengths = np.frombuffer(buffer, "<u8", int(self.cuts[-1]), at + 8 * (n + 1))
        self.rules = DigestArray(buffer, at + 8 * (n + 1) + 8 * len(self.lengths))
        at = -(-self.rules.end // 8) * 8
        self.blocks = np.frombuffer(buffer, "u1", len(self.rules.digests), at)

    @staticmethod
    def pack(rules: Iterable[tuple[str, str, str]], hashed: Callable[[bytes], int] = digest) -> bytes:
        """The buffer for distinct ``(host, path, verdict)``."""
        verdicts = {(h, p): v for h, p, v in rules}
        lengths: dict[str, set[int]] = {}
        for h, p in verdicts:
            lengths.setdefault(h, set()).add(len(p))
        hosts = list(lengths)
        packed_hosts, order = DigestArray.pack([h.encode() for h in hosts], hashed)
        each = [sorted(lengths[hosts[i]]) for i in order]
        cuts = np.cumsum([0, *map(len, each)]).astype("<u8")
        keys = list(verdicts)
        packed, at = DigestArray.pack([rule_key(h, p) for h, p in keys], hashed)
        blocks = bytes(verdicts[keys[i]] == BLOCK for i in at)
        return b"".join([packed_hosts, cuts.tobytes(), np.array([x for own in each for x in own], "<u8").tobytes(), packed, blocks])

    def judge(self, hosts: list[str], paths: list[str], hashed: Callable[[bytes], int] = digest):
        """Per url the longest fitting rule as (host, path, verdict), or ``None``."""
        known: dict[str, np.ndarray] = {}  # host of a rule -> its path lengths
        asked = {s for h in set(hosts) for s in suffixes(h)}
        names = list(asked)
        places = self.hosts.find([s.encode() for s in names], hashed)
        for name, k in zip(names, places.tolist()):
            if k >= 0:
                known[name] = self.lengths[int(self.cuts[k]) : int(self.cuts[k + 1])]
        probes: list[tuple[int, str, str]] = []
        for i, (host, path) in enumerate(zip(hosts, paths)):
            for s in suffixes(host):
                if s in known:
                    probes += [(i, s, path[: int(n)]) for n in known[s] if n <= len(path)]
        out: list[tuple[str, str, str] | None] = [None] * len(hosts)
        hits = self.rules.find([rule_key(h, p) for _, h, p in probes], hashed)
        for (i, h, p), k in zip(probes, hits.tolist()):
            best = out[i]
            if k >= 0 and (best is None or (len(h) + len(p), len(h)) > (len(best[0]) + len(best[1]), len(best[0]))):
                out[i] = h, p, BLOCK if self.blocks[k] else ALLOW
        return out


@lru_cache(maxsize=2)
def mapped(path: str) -> Rules:
    """The file, mapped once per Python worker; nothing of it is copied."""
    with open(path, "rb") as f:
        return Rules(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))


def distinct_rules(rules: DataFrame) -> DataFrame:
    """``host, path, verdict`` without rules that are null, repeated or neither allow nor block; block wins over allow."""
    host = F.translate(F.col("host"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sound = F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isin(ALLOW, BLOCK)
    return rules.filter(sound).groupBy(host.alias("host"), "path").agg(F.max("verdict").alias("verdict"))


def send_out(spark: SparkSession, raw: bytes) -> str:
    """Write a file into the shared folder and have Spark give every executor, also later ones, a copy."""
    path = spark._jvm.org.apache.hadoop.fs.Path(fresh_path(spark, "rules"))
    folder = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = folder.create(path)
    for at in range(0, len(raw), WRITE_BYTES):
        out.write(bytearray(raw[at : at + WRITE_BYTES]))
    out.close()
    spark.sparkContext.addFile(folder.makeQualified(path).toString())
    return path.getName()


def parts(pages: DataFrame) -> DataFrame:
    """``page_id, host, path``; both empty for a null url or one without ``://``."""
    url = F.coalesce("url", F.lit(""))
    host = F.translate(F.regexp_extract(url, URL, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.select("page_id", host.alias("host"), F.regexp_extract(url, URL, 2).alias("path"))


def judged_by_file(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``page_id, host, path, rule, verdict`` by the mapped array."""
    rows = rules.toArrow()
    raw = Rules.pack(zip(*(rows.column(c).to_pylist() for c in ("host", "path", "verdict"))) if rows.num_rows else ())
    name = send_out(urls.sparkSession, raw)

    def build():
        own = mapped(SparkFiles.get(name))

        def work(keys):
            cut = [k.find("/") if "/" in k else len(k) for k in keys]  # a path starts with / or is empty
            found = own.judge([k[:n] for k, n in zip(keys, cut)], [k[n:] for k, n in zip(keys, cut)])
            return [f and f[0] + f[1] for f in found], [f[2] if f else ALLOW for f in found]

        return work

    keyed = urls.withColumn("_key", F.concat("host", "path"))
    return map_texts(keyed, ["page_id", "host", "path"], "rule string, verdict string", build, "_key")


def judged_by_join(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The same by keyed joins of the probes of distinct urls with the rules."""
    each = urls.select("host", "path").distinct()
    dots = F.split("host", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(dots)), lambda i: F.array_join(F.slice(dots, i, F.size(dots)), "."))
    lengths = rules.groupBy("host").agg(F.collect_set(F.char_length("path")).alias("sizes")).withColumnRenamed("host", "rule_host")
    probes = each.withColumn("rule_host", F.explode(tails)).join(lengths, "rule_host")
    probes = probes.withColumn("n", F.explode("sizes")).filter(F.col("n") <= F.char_length("path"))
    probes = probes.select("host", "path", "rule_host", F.expr("left(path, n)").alias("rule_path"))
    named = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
    key = [F.char_length("rule_host") + F.char_length("rule_path"), F.char_length("rule_host")]
    hits = probes.join(named, ["rule_host", "rule_path"])
    best = hits.groupBy("host", "path").agg(
        F.max(F.struct(key[0].alias("n"), key[1].alias("h"), F.concat("rule_host", "rule_path").alias("rule"), "verdict")).alias("best")
    )
    return urls.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(ALLOW)).alias("verdict")
    )


def judge(pages: DataFrame, rules: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every page.

    ``rules``: ``host, path, verdict`` (allow or block).  A rule fits its host and all subdomains of it, if the
    url's path starts with the rule's path; host names of rules and urls are compared with A-Z lower-cased.
    The longest rule (host and path together, then the longer host) decides; a url that no rule fits is allowed
    and its ``rule`` is null.  Of equal rules with different verdicts block counts; rules with a null part or
    another verdict are left out.  Null urls and urls without ``://`` have an empty host and path.  Repeated
    pages give repeated results, empty tables an empty result or no rules; other columns are not looked at.
    """
    own = distinct_rules(rules)
    size = own.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 32)).first()[0] or 0
    urls = parts(pages)
    return judged_by_file(urls, own) if size <= file_bytes else judged_by_join(urls, own)
