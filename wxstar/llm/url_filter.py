"""URL rules in a sorted digest array.

The 64-bit XXH64 digests of all rule strings, sorted, are one memory-mapped file; a second file
holds the rule strings themselves. For each url every (host suffix, path prefix) that
could be a rule is hashed, all candidates of a batch are probed by one vectorised binary
search, and each hit is confirmed against the stored string, so a digest collision
never decides. The longest confirmed rule wins.

Files reach the executors through ``SparkContext.addFile`` from the shared folder. That
serves rule lists up to ``MAX_RULES`` (checked); a longer list is joined instead:
candidates and rules meet on the digest in a plain shuffle join, then on the string.

Defined results: a null url or one without ``://`` has an empty host and path and fits no rule.
Ports and user names are part of the host as the contract cuts it. A rule string without ``/`` has an empty path. Null or
empty rules are ignored; a rule listed with both actions blocks. Repeated rows are judged each for itself. With no rules every url gets
the default verdict. Only the id and the url column are read, so other columns can't clash.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wxstar.session import scratch_dir

MAX_RULES = 5_000_000  # bound of the memory-mapped form: 8 bytes and the string for each
CONTRACT_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
_A_TO_Z = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to / ? # or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), *_A_TO_Z)


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def parted(spark: SparkSession, rules: DataFrame) -> DataFrame:
    """Distinct rules (rule, action); where a rule has both actions it blocks."""
    return rules.where((F.col("rule") != "") & F.col("action").isin("block", "allow")).groupBy("rule").agg(
        F.max("action").alias("action"))


def digest_files(spark: SparkSession, rules: list[tuple[str, str]]) -> tuple[str, list[int], int]:
    """Writes the sorted digest array and the string table to the shared folder and gives
    them to all executors; returns their common name, the lengths of the rules' paths and the most host labels."""
    name = f"urlrules-{uuid.uuid4().hex[:12]}"
    rows = sorted((xxhash.xxh64_intdigest(r.encode()), r.encode(), a == "block") for r, a in rules)
    strings = [r for _, r, _ in rows]
    ends = np.cumsum([0, *map(len, strings)], dtype=np.int64)
    parts = {
        "keys": np.array([k for k, _, _ in rows], np.uint64).tobytes(),
        "ends": ends.tobytes(), "strings": b"".join(strings), "block": np.array([b for *_, b in rows], np.uint8).tobytes(),
    }
    jvm = spark._jvm
    for part, data in parts.items():
        path = jvm.org.apache.hadoop.fs.Path(f"{scratch_dir(spark)}/{name}.{part}")
        out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
        out.write(bytearray(data))
        out.close()
        spark.sparkContext.addFile(path.toString())
    hosts = [r.partition("/")[0] for r, _ in rules]
    lengths = sorted({len(r) - len(h) for (r, _), h in zip(rules, hosts)})
    return name, lengths, max((h.count(".") + 1 for h in hosts), default=0)


class DigestArray:
    """The memory-mapped files, on an executor."""

    def __init__(self, name: str):
        def mapped(part, kind):
            path = SparkFiles.get(f"{name}.{part}")
            return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)

        self.keys, self.ends = mapped("keys", np.uint64), mapped("ends", np.int64)
        self.strings, self.block = mapped("strings", np.uint8), mapped("block", np.uint8)

    def string(self, i: int) -> bytes:
        return self.strings[self.ends[i]:self.ends[i + 1]].tobytes()

    def probe(self, candidates: list[bytes]) -> np.ndarray:
        """Index of each candidate's rule, -1 where there is none."""
        digests = np.fromiter((xxhash.xxh64_intdigest(c) for c in candidates), np.uint64, len(candidates))
        at = np.searchsorted(self.keys, digests)
        found = np.full(len(candidates), -1, np.int64)
        for c in np.flatnonzero((at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == digests)):
            i = int(at[c])
            while i < len(self.keys) and self.keys[i] == digests[c]:  # equal digests stand together
                if self.string(i) == candidates[c]:
                    found[c] = i
                    break
                i += 1
        return found


def candidates(host: str, path: str, path_lengths: list[int], max_labels: int) -> list[str]:
    """Every rule string that would fit: host suffixes on label bounds, path prefixes of the known lengths."""
    labels = host.split(".")
    return [
        ".".join(labels[k:]) + path[:n]
        for k in range(max(0, len(labels) - max_labels), len(labels)) for n in path_lengths if n <= len(path)
    ]


def _probe_udf(name: str, path_lengths: list[int], max_labels: int):
    opened: list[DigestArray] = []

    @F.pandas_udf("rule string, block boolean")
    def longest_rule(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        if not opened:
            opened.append(DigestArray(name))
        rules = opened[0]
        for hosts, paths in batches:
            asked, row = [], []
            for i, (h, p) in enumerate(zip(hosts, paths)):
                own = candidates(h, p, path_lengths, max_labels) if h else []
                asked += own
                row += [i] * len(own)
            rule, block = np.full(len(hosts), None, object), np.full(len(hosts), None, object)
            found = rules.probe([a.encode() for a in asked]) if len(rules.keys) else np.full(len(asked), -1)
            for c in np.flatnonzero(found >= 0):
                i, text = row[c], asked[c]
                if rule[i] is None or len(text) > len(rule[i]):
                    rule[i], block[i] = text, bool(rules.block[found[c]])
            yield pd.DataFrame({"rule": rule, "block": block})

    return longest_rule


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", max_rules: int = MAX_RULES) -> DataFrame:
    """One row per page: id, host, path, rule (null if none fits), verdict (the rule's, else ``default``)."""
    spark = pages.sparkSession
    url = F.col("url").cast("string")
    asked = pages.select(F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path"))
    known = parted(spark, rules)
    if known.count() > max_rules:
        return _judge_joined(asked, known, default, id_col)
    files = digest_files(spark, [(r.rule, r.action) for r in known.toLocalIterator()])
    hit = F.when(F.col("__hit.block"), "block").when(~F.col("__hit.block"), "allow").otherwise(default)
    return asked.withColumn("__hit", _probe_udf(*files)("host", "path")).select(
        id_col, "host", "path", F.col("__hit.rule").alias("rule"), hit.alias("verdict"))


def _judge_joined(asked: DataFrame, known: DataFrame, default: str, id_col: str) -> DataFrame:
    """The same for rule lists beyond the bound: distinct (host, path) pairs meet the rules in a shuffle join."""
    pairs = asked.select("host", "path").distinct().where("host <> ''")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    prefixes = F.transform(F.sequence(F.lit(0), F.length("path")), lambda n: F.substring("path", F.lit(1), n))
    asked_for = pairs.withColumn("__s", F.explode(suffixes)).withColumn("__p", F.explode(prefixes)).select(
        "host", "path", F.concat("__s", "__p").alias("__text")).withColumn("__digest", F.xxhash64("__text"))
    rule = known.select("rule", "action", F.xxhash64("rule").alias("__digest"))
    best = asked_for.join(rule, "__digest").where("__text = rule").groupBy("host", "path").agg(
        F.max_by(F.struct("rule", "action"), F.length("rule")).alias("__hit"))
    return asked.join(best, ["host", "path"], "left").select(
        id_col, "host", "path", F.col("__hit.rule").alias("rule"), F.coalesce("__hit.action", F.lit(default)).alias("verdict"))


def contract_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CONTRACT_RULES, "rule string, action string")
