"""URL filter: allow and block entries in a trie over reversed host labels and path segments.

An entry (host, path) fits a URL whose host is the entry's or a subdomain of it
and whose path starts with the entry's.  Of the entries that fit, the one with
the most host labels wins, then the one with the longest path; if the same entry
is given as allow and block, allow wins.  Without a fitting entry the verdict is
``default``.

The trie is broadcast while the list has at most ``MOST_BROADCAST`` entries; a
longer list stays a table and is joined by host suffix and path prefix, with the
same result.  Defined cases: a URL that is NULL or has no ``://`` has an empty host
and path, which no entry fits; an entry needs a host.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm.cluster import cut, unused_name

MOST_BROADCAST = 200_000
ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Entry:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass
class _Node:
    below: dict[str, _Node] = field(default_factory=dict)
    paths: _Node | None = None  # at a host: the trie of path segments
    ends: dict[str, Entry] = field(default_factory=dict)  # at a path: entries by the start of the next segment
    lengths: list[int] = field(default_factory=list)  # of these starts, each once, descending

    def child(self, name: str) -> _Node:
        return self.below.setdefault(name, _Node())


class Trie:
    def __init__(self, entries: Iterable[Entry]):
        self.root = _Node()
        for entry in entries:
            if not entry.host or entry.verdict not in (ALLOW, BLOCK):
                raise ValueError(f"not an entry: {entry}")
            node = self.root
            for label in reversed(entry.host.split(".")):
                node = node.child(label)
            node.paths = node.paths or _Node()
            node = node.paths
            *segments, start = entry.path.split("/")
            for segment in segments:
                node = node.child(segment)
            if node.ends.get(start, entry).verdict != ALLOW or entry.verdict == ALLOW:
                node.ends[start] = entry
                if len(start) not in node.lengths:
                    node.lengths = sorted([*node.lengths, len(start)], reverse=True)

    def find(self, host: str, path: str) -> Entry | None:
        hosts, node = [], self.root
        for label in reversed(host.split(".")):
            node = node.below.get(label)
            if node is None:
                break
            if node.paths:
                hosts.append(node.paths)
        for paths in reversed(hosts):
            found = max(self._fitting(paths, path), key=lambda entry: len(entry.path), default=None)
            if found:
                return found
        return None

    @staticmethod
    def _fitting(node: _Node | None, path: str) -> Iterator[Entry]:
        for segment in path.split("/"):
            if node is None:
                return
            # one lookup for each length that starts have, however many starts there are
            for length in node.lengths:
                entry = node.ends.get(segment[:length]) if length <= len(segment) else None
                if entry:
                    yield entry
                    break
            node = node.below.get(segment)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def judged(spark: SparkSession, entries: list[Entry], host: Column, path: Column, default: str = ALLOW) -> Column:
    """struct<rule, verdict> by a broadcast trie; ``entries`` is at most MOST_BROADCAST long."""
    if len(entries) > MOST_BROADCAST:
        raise ValueError(f"{len(entries)} entries: use judge_by_join")
    shared = spark.sparkContext.broadcast(Trie(entries))

    @F.arrow_udf("struct<rule: string, verdict: string>")
    def verdicts(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        found = [shared.value.find(h or "", p or "") for h, p in zip(hosts.to_pylist(), paths.to_pylist())]
        rules = pa.array([entry and entry.name for entry in found], pa.string())
        return pa.StructArray.from_arrays(
            [rules, pa.array([entry.verdict if entry else default for entry in found], pa.string())],
            ["rule", "verdict"],
        )

    return verdicts.asNondeterministic()(host, path)


def judge_by_join(parts: DataFrame, entries: DataFrame, default: str = ALLOW) -> DataFrame:
    """(host, path, rule, verdict) for the distinct (host, path) of ``parts``.

    ``entries`` (verdict, host, path) may have any length.  A URL meets an entry
    under one of its host suffixes and one of its leading runs of whole segments.
    """
    distinct = cut(parts.select("host", "path").distinct())
    labels, segments = F.split("host", r"\."), F.split("path", "/")
    tries = (
        distinct.withColumn("k", F.explode(F.sequence(F.lit(1), F.size(labels))))
        .withColumn("suffix", F.array_join(F.slice(labels, -F.col("k"), F.col("k")), "."))
        .withColumn("m", F.explode(F.sequence(F.lit(0), F.size(segments) - 1)))
        .withColumn("head", F.when(F.col("m") == 0, "").otherwise(
            F.concat(F.array_join(F.slice(segments, 1, F.col("m")), "/"), F.lit("/"))))
    )
    rules = entries.select(
        F.col("host").alias("suffix"),
        F.regexp_extract("path", "^(.*/)?", 0).alias("head"),
        F.col("path").alias("entry_path"),
        F.col("verdict").alias("entry_verdict"),
    )
    best = (
        tries.join(rules, ["suffix", "head"])
        .where("startswith(path, entry_path)")
        .groupBy("host", "path")
        .agg(
            F.max_by(
                F.struct(F.concat("suffix", "entry_path").alias("rule"), F.col("entry_verdict").alias("verdict")),
                F.struct("k", F.length("entry_path"), F.col("entry_verdict") == ALLOW),
            ).alias("best")
        )
    )
    return distinct.join(best, ["host", "path"], "left").select(
        "host", "path", "best.rule", F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )


def filter_urls(
    spark: SparkSession, pages: DataFrame, entries: list[Entry] | DataFrame, url: str = "url", default: str = ALLOW
) -> DataFrame:
    """``pages`` with one more column: struct<host, path, rule, verdict>.

    It is called ``judged``, with a ``_`` more as long as ``pages`` has a column of that name.
    """
    name = unused_name(pages, "judged")
    host, path = url_host(F.col(url)), url_path(F.col(url))
    if isinstance(entries, DataFrame):
        rows = entries.select("verdict", "host", "path").limit(MOST_BROADCAST + 1).collect()
        if len(rows) > MOST_BROADCAST:
            parts = pages.select(host.alias("host"), path.alias("path")).where("host <> ''")
            verdicts = judge_by_join(parts, entries, default).select(F.struct("host", "path", "rule", "verdict").alias(name))
            same = (host == F.col(f"{name}.host")) & (path == F.col(f"{name}.path"))
            # no entry fits an empty host, which may be that of many pages: they are not joined
            none = F.struct(host.alias("host"), path.alias("path"), F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
            return pages.where(host != "").join(verdicts, same).unionByName(pages.where(host == "").withColumn(name, none))
        entries = [Entry(*row) for row in rows]
    found = judged(spark, entries, host, path, default)
    return pages.withColumn(name, F.struct(host.alias("host"), path.alias("path"), found.alias("found"))).withColumn(
        name, F.struct(f"{name}.host", f"{name}.path", f"{name}.found.rule", f"{name}.found.verdict")
    )
