"""URL filter: a trie over reversed host labels and path segments, longest match first."""

from __future__ import annotations

from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT = "allow"
# Most rules that are sent to the tasks.
MAX_RULES = 1_000_000


@dataclass(slots=True)
class Node:
    """Where a host label or a path segment leads; ``rule`` is the rule that ends here."""

    labels: dict[str, Node] = field(default_factory=dict)
    segments: dict[str, Node] = field(default_factory=dict)
    # Last, unfinished path segments of rules: a url's segment fits if it starts with one.
    starts: dict[str, tuple[str, str]] = field(default_factory=dict)
    rule: tuple[str, str] | None = None


def build(rules: list[tuple[str, str, str]]) -> Node:
    """Trie of ``(host, path, verdict)``; of rules that repeat host and path, block wins."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are sent to the tasks")
    root = Node()
    for host, path, verdict in sorted(rules, key=lambda r: r[2] == "block"):
        node = root
        for label in reversed(host.lower().split(".")):
            node = node.labels.setdefault(label, Node())
        *whole, rest = path.split("/")
        for segment in whole:
            node = node.segments.setdefault(segment, Node())
        found = (host.lower() + path, verdict)
        if rest:
            node.starts[rest] = found
        else:
            node.rule = found
    return root


def _longest_path(node: Node, path: str) -> tuple[str, str] | None:
    best = node.rule
    parts = path.split("/")
    for i, part in enumerate(parts):
        best = max(((s, r) for s, r in node.starts.items() if part.startswith(s)), key=lambda x: len(x[0]), default=(0, best))[1]
        if i == len(parts) - 1 or part not in node.segments:
            return best
        node = node.segments[part]
        best = node.rule or best
    return best


def match(root: Node, host: str, path: str) -> tuple[str, str] | None:
    """The rule with the longest host that fits, and under it the longest path."""
    node, best = root, None
    for label in reversed(host.split(".")):
        node = node.labels.get(label)
        if node is None:
            break
        best = _longest_path(node, path) or best
    return best


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (these replace columns so named).

    A rule ``(host, path, verdict)`` fits its host and all subdomains if the url's path starts with its
    path. The longest host wins, then the longest path. Without a rule, ``rule`` is null and ``verdict``
    is ``default``. A null url and one without ``://`` have empty host and path. Every row is judged on
    its own, so repeated rows and ties need no care; no rows give no rows. The trie goes to the tasks with
    the job; ``MAX_RULES`` bounds it.
    """
    sent = pages.sparkSession.sparkContext.broadcast(build(rules))

    @F.pandas_udf("rule string, verdict string")
    def judged(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        root = sent.value
        found = [match(root, h, p) or (None, default) for h, p in zip(hosts, paths)]
        return pd.DataFrame(found, columns=["rule", "verdict"])

    with_parts = pages.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    seen = with_parts.withColumn("__judged", judged("host", "path"))
    return seen.withColumns({"rule": F.col("__judged.rule"), "verdict": F.col("__judged.verdict")}).drop("__judged")
