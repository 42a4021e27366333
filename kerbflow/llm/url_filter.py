"""URL filter: a trie over reversed host labels and path segments, longest match wins."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbflow.llm.common import ascii_lower, own_names

ALLOW, BLOCK = "allow", "block"
OUTPUTS = ("host", "path", "rule", "verdict")


@dataclass(frozen=True)
class Rule:
    """``host`` with all its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def label(self) -> str:
        return self.host + self.path

    @property
    def rank(self) -> tuple[int, int, bool]:
        """Longest rule first, then the longer host; of two equal rules the block wins."""
        return (len(self.label), len(self.host), self.verdict == BLOCK)


@dataclass
class _Paths:
    """Path segments below one host.  ``ends`` maps the last, possibly cut, segment to its rule."""

    below: dict[str, _Paths] = field(default_factory=dict)
    ends: dict[str, Rule] = field(default_factory=dict)


@dataclass
class _Hosts:
    below: dict[str, _Hosts] = field(default_factory=dict)
    paths: _Paths | None = None


class UrlTrie:
    """Host labels from the right, then path segments from the left.

    A rule path ends inside a segment (``/en`` also fits ``/english``) unless it ends with
    a slash, so its last segment is matched as a prefix.
    """

    def __init__(self, rules: Iterable[Rule]):
        self.root = _Hosts()
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.split(".")):
                node = node.below.setdefault(label, _Hosts())
            if node.paths is None:
                node.paths = _Paths()
            *whole, last = rule.path.split("/")
            paths = node.paths
            for segment in whole:
                paths = paths.below.setdefault(segment, _Paths())
            held = paths.ends.get(last)
            if held is None or rule.rank > held.rank:
                paths.ends[last] = rule

    def find(self, host: str, path: str) -> Rule | None:
        best: Rule | None = None
        segments = path.split("/")
        node = self.root
        for label in reversed(host.split(".")):
            node = node.below.get(label)
            if node is None:
                break
            if node.paths is not None:
                for rule in _fitting(node.paths, segments):
                    if best is None or rule.rank > best.rank:
                        best = rule
        return best


def _fitting(paths: _Paths, segments: list[str]) -> Iterator[Rule]:
    for segment in segments:
        for end, rule in paths.ends.items():
            if segment.startswith(end):
                yield rule
        paths = paths.below.get(segment)
        if paths is None:
            return


def host_of(url: Column) -> Column:
    """What follows the first ``://``, up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


@own_names
def judge_urls(
    df: DataFrame,
    rules: list[Rule],
    url: str = "url",
    default: str = ALLOW,
    max_broadcast_chars: int = 16_000_000,
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to each row.

    The trie is broadcast; its size is bounded by ``max_broadcast_chars`` characters of
    rules.  A longer rule list is matched by equi-joins on host suffixes instead, with the
    same result.  Null urls and urls without ``://`` have an empty host and path, which
    only a rule with an empty host could fit, so they get ``default``.  Rows are never
    merged or dropped; an empty table gives an empty result; an empty rule list gives
    every row the default.
    """
    work = df.drop(*(n for n in OUTPUTS if n != url)) if url not in OUTPUTS else df
    work = work.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    if sum(len(r.label) + 1 for r in rules) > max_broadcast_chars:
        return _judge_by_join(work, rules, default)
    held = df.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    @F.pandas_udf("rule string, verdict string")
    def match(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        trie = held.value
        found = [trie.find(h, p) for h, p in zip(host, path)]
        return pd.DataFrame(
            {
                "rule": [None if r is None else r.label for r in found],
                "verdict": [default if r is None else r.verdict for r in found],
            },
            dtype=object,
        )

    judged = work.withColumn("verdict", match("host", "path"))
    return judged.withColumn("rule", F.col("verdict.rule")).withColumn("verdict", F.col("verdict.verdict"))


def _judge_by_join(work: DataFrame, rules: list[Rule], default: str) -> DataFrame:
    """The same by shuffle joins, for rule lists too large to broadcast."""
    spark = work.sparkSession
    listed = spark.createDataFrame(
        [(r.host, r.path, r.label, r.verdict, *r.rank[:2], int(r.rank[2])) for r in rules],
        "_host string, _start string, _rule string, _verdict string, _r1 int, _r2 int, _r3 int",
    )
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    pairs = work.select("host", "path").distinct()
    best = (
        pairs.withColumn("_host", F.explode(suffixes))
        .join(listed, "_host")
        .where(F.col("path").startswith(F.col("_start")))
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("_rule", "_verdict"), F.struct("_r1", "_r2", "_r3")).alias("_best"))
    )
    return (
        work.join(best, ["host", "path"], "left")
        .withColumn("rule", F.col("_best._rule"))
        .withColumn("verdict", F.coalesce(F.col("_best._verdict"), F.lit(default)))
        .drop("_best")
    )
