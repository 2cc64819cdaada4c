"""URL filters by a sorted digest array.

A list entry is a host and a path, written ``host/path``; it fits its host and all subdomains where the url's path starts
with its own. The list becomes one file: sorted 64-bit xxhash keys, then the full strings in the same order. Spark brings
the file to every machine once; tasks map it into memory, probe all host suffixes and path prefixes of a batch of urls by
one vectorised binary search, and compare the stored string of each hit, so a collision of digests never decides.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablespoon.session import scratch_dir

LIST_BYTES = 256 << 20  # a longer list is joined instead of sent to every machine
_WRITE = 4 << 20


@dataclass(frozen=True)
class Entry:
    text: str  # host/path
    verdict: str  # allow or block
    rule: bool = True  # a rule is named in the result; other entries are the method's own list

    def sort_key(self) -> tuple:
        return (xxhash.xxh64_intdigest(self.text), self.text)


def packed(entries: list[Entry]) -> bytes:
    """The file: counts and the longest host, path lengths, keys, string ends, flags, strings."""
    ordered = sorted({e.text: e for e in sorted(entries, key=lambda e: (e.rule, e.verdict))}.values(), key=Entry.sort_key)
    strings = [e.text.encode() for e in ordered]
    lengths = sorted({len(e.text) - e.text.index("/") for e in ordered})
    flags = np.array([2 * e.rule + (e.verdict == "block") for e in ordered], dtype=np.int64)
    keys = np.array([e.sort_key()[0] for e in ordered], dtype="<u8")
    longest = max((e.text.index("/") for e in ordered), default=0)
    head = np.array([len(ordered), len(lengths), longest], dtype="<i8")
    ends = np.cumsum([0, *map(len, strings)]).astype("<i8")
    return b"".join([head.tobytes(), np.array(lengths, "<i8").tobytes(), keys.tobytes(), ends.tobytes(), flags.tobytes(), *strings])


class DigestArray:
    """A mapped list file."""

    def __init__(self, path: str):
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        n, lengths, self.longest_host = (int(x) for x in raw[:24].view("<i8"))
        self.path_lengths = raw[24 : 24 + 8 * lengths].view("<i8").tolist()
        at = 24 + 8 * lengths
        self.keys = raw[at : at + 8 * n].view("<u8")
        self.ends = raw[at + 8 * n : at + 16 * n + 8].view("<i8")
        self.flags = raw[at + 16 * n + 8 : at + 24 * n + 8].view("<i8")
        self.strings = raw[at + 24 * n + 8 :]

    def find(self, texts: list[str]) -> np.ndarray:
        """Place of each text in the list, or -1."""
        digests = np.fromiter(map(xxhash.xxh64_intdigest, texts), dtype=np.uint64, count=len(texts))
        slot = np.searchsorted(self.keys, digests)
        out = np.full(len(texts), -1, dtype=np.int64)
        for i in np.flatnonzero(slot < len(self.keys)):
            at = int(slot[i])
            while at < len(self.keys) and self.keys[at] == digests[i]:  # equal keys stand side by side
                if self.strings[int(self.ends[at]) : int(self.ends[at + 1])].tobytes() == texts[i].encode():
                    out[i] = at
                    break
                at += 1
        return out


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): host from the first ``://`` up to ``/``, ``?``, ``#``; path up to ``?``, ``#``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    cut = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    rest = rest[:cut]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def _probes(host: str, path: str, lengths: list[int], longest: int) -> Iterator[str]:
    """Suffixes of ``host`` no longer than the longest listed host, each with the prefixes of ``path`` that may be listed."""
    fitting = [path[:n] for n in lengths if n <= len(path)]
    if not host or not fitting:
        return
    at = 0 if len(host) <= longest else host.find(".", len(host) - longest - 1) + 1
    while at or len(host) <= longest:
        suffix = host[at:]
        yield from (suffix + p for p in fitting)
        dot = host.find(".", at)
        if dot < 0:
            return
        at = dot + 1


def _judge(name: str, key: str, url: str, default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = DigestArray(SparkFiles.get(name))
        for batch in batches:
            parts = [split_url(x.as_py()) for x in batch.column(batch.schema.get_field_index(url))]
            probes, row = [], []
            for i, (host, path) in enumerate(parts):
                before = len(probes)
                probes.extend(_probes(host, path, listed.path_lengths, listed.longest_host))
                row += [i] * (len(probes) - before)
            best: dict[int, tuple] = {}
            for i, text, at in zip(row, probes, listed.find(probes).tolist()):
                if at >= 0:
                    flag = int(listed.flags[at])
                    best[i] = max(best.get(i, ()), (flag >= 2, len(text), text, flag % 2 == 1))
            verdict = [("block" if best[i][3] else "allow") if i in best else default for i in range(len(parts))]
            yield pa.RecordBatch.from_pydict(
                {
                    key: batch.column(batch.schema.get_field_index(key)),
                    "host": pa.array([p[0] for p in parts], pa.string()),
                    "path": pa.array([p[1] for p in parts], pa.string()),
                    "rule": pa.array([best[i][2] if i in best and best[i][0] else None for i in range(len(parts))], pa.string()),
                    "verdict": pa.array(verdict, pa.string()),
                    "entry": pa.array([best[i][2] if i in best else None for i in range(len(parts))], pa.string()),
                }
            )

    return run


def _shared_file(spark: SparkSession, content: bytes) -> str:
    """Put a file into the shared folder and on every machine that runs tasks; returns its name."""
    name = f"urls-{uuid.uuid4().hex}.bin"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{scratch_dir(spark, 'urls')}/{name}")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    for at in range(0, len(content), _WRITE):
        out.write(bytearray(content[at : at + _WRITE]))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def named_hosts(pages: DataFrame, names, url: str = "url") -> DataFrame:
    """(host) of every different registered host in ``pages`` that has one of ``names`` as a label, under whatever domain.

    A host counts from the name on, the last one if it has several; a name without a domain after it is no such host.
    """
    named = rf"(?s)^(?:.*\.)?((?:{'|'.join(map(re.escape, names))})\..+)$"
    hosts = pages.select(F.regexp_extract(_parts(url)[0], named, 1).alias("host"))
    return hosts.where(F.col("host") != "").distinct()


def filter_urls(
    pages: DataFrame,
    entries: list[Entry],
    key: str = "page_id",
    url: str = "url",
    default: str = "allow",
    list_bytes: int = LIST_BYTES,
    blocked: DataFrame | None = None,
) -> DataFrame:
    """(key, host, path, rule, verdict, entry) of every row.

    The longest fitting rule decides; without one, the longest fitting entry of the method's own list; without that,
    ``default``. ``rule`` names the rule (null without), ``entry`` what decided. A null url, or one without ``://``, has an
    empty host and path and fits nothing; an entry listed twice counts as a rule if it is one anywhere, and as block if
    its verdicts differ. Repeated rows are judged one by one; an empty table gives no rows. ``blocked`` is a table of (host)
    that is listed as well, to be blocked with all its paths; it comes to the driver only if the list stays below
    ``list_bytes``, and is joined as it is otherwise.
    """
    size = sum(len(e.text.encode()) + 24 for e in entries)
    if blocked is not None:
        size += blocked.agg(F.coalesce(F.sum(F.octet_length("host") + 25), F.lit(0)).alias("n")).first().n
    if size > list_bytes:
        return joined_urls(pages, entries, key, url, default, blocked)
    if blocked is not None:
        entries = [*entries, *(Entry(f"{r.host}/", "block", rule=False) for r in blocked.toLocalIterator())]
    content = packed(entries)
    kind = dict(pages.dtypes)[key]
    schema = f"`{key}` {kind}, host string, path string, rule string, verdict string, entry string"
    return pages.select(key, url).mapInArrow(_judge(_shared_file(pages.sparkSession, content), key, url, default), schema)


def _parts(url: str) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    rest = F.regexp_extract(rest, r"(?s)^([^?#]*)", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/]*(.*)$", 1)


def joined_urls(
    pages: DataFrame,
    entries: list[Entry],
    key: str = "page_id",
    url: str = "url",
    default: str = "allow",
    blocked: DataFrame | None = None,
) -> DataFrame:
    """As :func:`filter_urls`, by a join of all probes with the list, for lists too long for a file on every machine."""
    spark = pages.sparkSession
    given = spark.createDataFrame([(e.text, e.verdict, e.rule) for e in entries], "text string, verdict string, is_rule boolean")
    if blocked is not None:
        given = given.unionByName(blocked.select(F.concat("host", F.lit("/")).alias("text"), F.lit("block").alias("verdict"), F.lit(False).alias("is_rule")))
    listed = given.groupBy("text").agg(F.max(F.struct("is_rule", "verdict")).alias("e")).select("text", "e.*")
    found = listed.select(F.instr("text", "/").alias("host"), F.length("text").alias("n")).agg(
        F.coalesce(F.max("host") - 1, F.lit(0)).alias("longest"), F.collect_set(F.col("n") - F.col("host") + 1).alias("lengths")
    ).first()  # path lengths of a list are few
    lengths = F.array(*map(F.lit, sorted(found.lengths))) if found.lengths else F.array().cast("array<int>")
    host, path = _parts(url)
    rows = pages.select(key, host.alias("host"), path.alias("path"))
    labels = F.split(F.right("host", F.lit(found.longest + 1)), r"\.")  # a suffix begins after a dot, or is the whole host
    behind = F.when(F.size(labels) > 1, F.transform(F.sequence(F.lit(2), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    whole = F.when(F.length("host") <= found.longest, F.array("host"))
    none = F.array().cast("array<string>")
    suffixes = F.concat(F.coalesce(whole, none), F.coalesce(behind, none))
    fitting = F.filter(lengths, lambda n: n <= F.length("path"))
    probes = F.when(
        (F.length("host") > 0) & (F.size(fitting) > 0),
        F.flatten(F.transform(suffixes, lambda s: F.transform(fitting, lambda n: F.concat(s, F.substring(F.col("path"), F.lit(1), n))))),
    )
    urls = rows.select("host", "path").distinct().withColumn("text", F.explode(probes))
    best = urls.join(listed, "text").groupBy("host", "path").agg(
        F.max(F.struct("is_rule", F.length("text").alias("n"), "text", "verdict")).alias("b")
    )
    return rows.join(best, ["host", "path"], "left").select(
        key,
        "host",
        "path",
        F.when(F.col("b.is_rule"), F.col("b.text")).alias("rule"),
        F.coalesce("b.verdict", F.lit(default)).alias("verdict"),
        F.col("b.text").alias("entry"),
    )
