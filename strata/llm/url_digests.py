"""URL verdicts from rules and a sharded, sorted array of 64-bit digests.

The block list may be far larger than an executor's memory.  It is cut into
shards by the digest of its entries; each shard is one byte string: the sorted
xxHash64 keys, the offsets of their strings, and the strings.  URLs are probed
beside their shard: a task writes the shard it meets to a temporary file, maps
it into memory, probes batches by vectorised binary search, and confirms every
hit on the stored string, so digests that collide never decide.

An entry is ``host/path``.  With the path ``/`` it covers the host and all its
subdomains, else exactly that host and path.  Rules are few and are passed as
a parameter: a rule fits its host and all subdomains if the URL's path starts
with the rule's; the longest fitting rule wins (by its whole text, then by
name), and a URL that no rule fits gets the list's verdict.

Defined results: a null URL, or one without ``://``, has an empty host and
path, fits no rule and no entry, and is allowed.  Repeated rows each get their
verdict.  An empty list or table gives an empty array or result.  Extra
columns are ignored.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from strata.operators.staging import stage

SEED = 42  # the seed of Spark's xxhash64

#: Bytes of a shard: strings, and 16 for each entry's digest and offset.
SHARD_BYTES = 8 << 20


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def probe_keys(host: Column, path: Column) -> Column:
    """Every entry that would cover the URL: ``host/path``, and ``h/`` for the host and its parents."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.concat(F.array_join(F.slice(labels, i, F.size(labels)), "."), F.lit("/")),
    )
    exact = F.concat(host, F.when(path == "", "/").otherwise(path))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.array_append(suffixes, exact))
    )


def best_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest fitting rule's text, else null.  ``rules``: (verdict, ``host/path``)."""
    ordered = sorted({text for _, text in rules}, key=lambda text: (-len(text), text))
    fits = []
    for text in ordered:
        rule_host, _, rest = text.partition("/")
        inside = (host == rule_host) | host.endswith(f".{rule_host}")
        fits.append(F.when((host != "") & inside & path.startswith(f"/{rest}"), F.lit(text)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def digest_shards(entries: DataFrame, shards: int) -> DataFrame:
    """The list as ``shards`` sorted arrays: ``shard int``, ``content binary``.

    ``entries`` has one column, ``entry``.  A shard is built and probed in one
    task's memory: ``shards_for`` tells how many that takes.
    """

    def build(group: pd.DataFrame) -> pd.DataFrame:
        keys = group["digest"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(keys, kind="stable")
        strings = [group["entry"].iloc[i].encode() for i in order]
        offsets = np.zeros(len(strings) + 1, np.uint64)
        offsets[1:] = np.cumsum([len(s) for s in strings])
        parts = [np.array([len(strings)], np.uint64), keys[order], offsets]
        content = b"".join(p.tobytes() for p in parts) + b"".join(strings)
        return pd.DataFrame({"shard": [group["shard"].iloc[0]], "content": [content]})

    keyed = entries.select(F.col("entry").cast("string").alias("entry")).where("entry is not null").distinct()  # an entry has one digest
    keyed = keyed.withColumn("digest", F.xxhash64("entry")).withColumn("shard", _shard("digest", shards))
    return keyed.groupBy("shard").applyInPandas(build, "shard int, content binary")


def shards_for(entries: DataFrame, shard_bytes: int | None = None) -> int:
    """As many shards as leave each about ``shard_bytes`` (``SHARD_BYTES``) of the list; digests deal entries evenly."""
    held = entries.agg(F.sum(F.octet_length("entry") + 16)).first()[0] or 0
    return max(1, -(-held // (shard_bytes or SHARD_BYTES)))


def _shard(digest: str, shards: int) -> Column:
    return F.pmod(F.col(digest), F.lit(shards)).cast("int")


class DigestArray:
    """One shard, mapped into memory."""

    def __init__(self, content: bytes):
        with tempfile.TemporaryFile() as file:  # gone when the map goes
            file.write(content)
            file.flush()
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        n = int(np.frombuffer(self.map, np.uint64, 1)[0])
        self.keys = np.frombuffer(self.map, np.uint64, n, 8)
        self.offsets = np.frombuffer(self.map, np.uint64, n + 1, 8 + 8 * n)
        self.base = 16 + 16 * n

    def contains(self, digests: np.ndarray, strings: list[str]) -> np.ndarray:
        """Which strings the list holds; equal digests are told apart by their strings."""
        low = np.searchsorted(self.keys, digests, "left")
        high = np.searchsorted(self.keys, digests, "right")
        found = np.zeros(len(strings), bool)
        for i in np.flatnonzero(high > low):
            wanted = strings[i].encode()
            found[i] = any(self._string(j) == wanted for j in range(low[i], high[i]))
        return found

    def _string(self, j: int) -> bytes:
        return self.map[self.base + int(self.offsets[j]) : self.base + int(self.offsets[j + 1])]


def listed(probes: DataFrame, shards: DataFrame, n_shards: int) -> DataFrame:
    """The distinct ``key`` values of ``probes(key)`` that the list holds.

    Probes are made distinct first, so a hot host is one probe.  Each shard is
    dealt to several tasks, as many as keep all shuffle partitions busy, and
    its probes are spread over them; a task streams its probes past the map.
    """
    parts = max(n_shards, int(probes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    copies = -(-parts // n_shards)
    keyed = probes.select("key").distinct().withColumn("digest", F.xxhash64("key"))
    spread = F.pmod(F.shiftright("digest", 32), F.lit(copies)).cast("int")
    asked = keyed.select(
        _shard("digest", n_shards).alias("shard"), spread.alias("copy"), "key", "digest", F.lit(None).cast("binary").alias("content")
    )
    held = shards.select(
        "shard",
        F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"),
        F.lit(None).cast("string").alias("key"),
        F.lit(0).cast("long").alias("digest"),
        "content",
    )

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, array = None, None
        for batch in batches:
            blobs = batch["content"].notna()
            place = batch["shard"].to_numpy()
            # runs of one shard, each led by its array where the list has one
            cuts = np.flatnonzero(blobs.to_numpy() | (np.diff(place, prepend=place[:1]) != 0))
            for start, stop in zip([0, *cuts], [*cuts, len(batch)]):
                run = batch.iloc[start:stop]
                if run.empty:
                    continue
                if run["shard"].iloc[0] != at:
                    at, array = run["shard"].iloc[0], None
                if run["content"].iloc[0] is not None:
                    array, run = DigestArray(run["content"].iloc[0]), run.iloc[1:]
                if array is not None and len(run):
                    hits = array.contains(run["digest"].to_numpy(np.int64).view(np.uint64), list(run["key"]))
                    yield pd.DataFrame({"key": run["key"][hits]})

    dealt = asked.unionByName(held).repartition(parts, "shard", "copy")
    return dealt.sortWithinPartitions("shard", F.col("content").isNull()).mapInPandas(probe, "key string")


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str]], entries: DataFrame, n_shards: int | None = None
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages(page_id, url)``.

    The list is cut into ``n_shards``, by default as many as its bytes take.
    """
    entries = stage(entries.select(F.col("entry").cast("string").alias("entry")).where("entry is not null").distinct(), "url-list")
    n_shards = n_shards or shards_for(entries)
    verdicts = dict((text, verdict) for verdict, text in rules)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    parsed = rows.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = parsed.withColumn("rule", best_rule(F.col("host"), F.col("path"), rules))
    urls = ruled.where("rule is null").select("host", "path").distinct()
    keyed = stage(urls.select("host", "path", F.explode(probe_keys(F.col("host"), F.col("path"))).alias("key")), "url-keys")
    hits = listed(keyed, digest_shards(entries, n_shards), n_shards)
    blocked = keyed.join(hits, "key", "left_semi").select("host", "path").distinct().withColumn("blocked", F.lit(True))
    by_rule = F.element_at(F.create_map(*[F.lit(x) for pair in verdicts.items() for x in pair]), F.col("rule"))
    by_list = F.when(F.col("blocked"), "block").otherwise("allow")
    return ruled.join(blocked, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), by_rule).otherwise(by_list).alias("verdict")
    )
