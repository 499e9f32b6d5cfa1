"""Allow and block rules for URLs in a trie over reversed host labels and path segments.

The trie holds the rules only; its size is checked before it is sent to the
executors. Each URL walks it once: labels from the right, then path segments.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rules beyond this many characters in all are refused, as every executor gets a copy.
MAX_RULE_CHARS = 64_000_000

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_HOST_END = re.compile(r"[/?#]")
_PATH_END = re.compile(r"[?#]")


@dataclass(frozen=True)
class UrlRule:
    """Verdict ("allow" or "block") for a host with its subdomains and a path prefix that begins with "/"."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


@dataclass
class _Node:
    labels: dict[str, _Node] = field(default_factory=dict)
    #: below a host: whole segments (each closed by "/"), and rules by the open segment they end in
    segments: dict[str, _Node] = field(default_factory=dict)
    rules: dict[str, UrlRule] = field(default_factory=dict)
    paths: _Node | None = None


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): what stands behind the first ``://``, A-Z of the host
    lower-cased; both empty for null or without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = _HOST_END.search(rest)
    host = rest[: end.start()] if end else rest
    after = rest[len(host) :]
    stop = _PATH_END.search(after)
    return host.translate(_UPPER), after[: stop.start()] if stop else after


class UrlTrie:
    """Longest-match lookup: the rule with the longest host, then the longest path.

    Of two rules with the same host and path, block wins.
    """

    def __init__(self, rules: Iterable[UrlRule]):
        self.root = _Node()
        size = 0
        for rule in rules:
            size += len(rule.name)
            if size > MAX_RULE_CHARS:
                raise ValueError(f"rules of more than {MAX_RULE_CHARS} characters")
            node = self.root
            for label in reversed(rule.host.translate(_UPPER).split(".")):
                node = node.labels.setdefault(label, _Node())
            node.paths = node.paths or _Node()
            node = node.paths
            *closed, open_end = rule.path.split("/")
            for segment in closed:
                node = node.segments.setdefault(segment, _Node())
            if open_end not in node.rules or rule.verdict == "block":
                node.rules[open_end] = rule

    def match(self, host: str, path: str) -> UrlRule | None:
        if not host:
            return None
        reached: list[_Node] = []
        node: _Node | None = self.root
        for label in reversed(host.split(".")):
            node = node.labels.get(label)
            if node is None:
                break
            if node.paths is not None:
                reached.append(node.paths)
        segments = path.split("/")
        for start in reversed(reached):
            found, node = None, start
            for segment in segments:
                for n in range(len(segment), -1, -1) if node.rules else ():
                    if segment[:n] in node.rules:
                        found = node.rules[segment[:n]]
                        break
                node = node.segments.get(segment)
                if node is None:
                    break
            if found is not None:
                return found
        return None


def filter_urls(
    pages: DataFrame, rules: Iterable[UrlRule], *, url_col: str = "url", default: str = "allow", keep: tuple[str, ...] = ()
) -> DataFrame:
    """The columns ``keep`` of every row, then host, path, rule and verdict.

    Row-local: nothing is shuffled. Defined cases: a null url, an empty one and
    one without ``://`` have an empty host and path and get ``default``; a host
    with a port or user matches no rule by its last label; rows repeated or with
    null ids are judged each; an empty table gives no rows. Other columns of
    ``pages`` are dropped, so clashing names do no harm.
    """
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    def judged(urls: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in urls:
            rows = []
            for url in batch:
                host, path = split_url(url)
                rule = trie.value.match(host, path)
                rows.append((host, path, rule.name if rule else None, rule.verdict if rule else default))
            yield pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"], dtype=object)

    # a Python function over an iterator of batches, so the trie is unpacked once per task
    verdict = F.pandas_udf(judged, "host string, path string, rule string, verdict string")
    return pages.select(*keep, verdict(F.col(url_col)).alias("_v")).select(*keep, "_v.host", "_v.path", "_v.rule", "_v.verdict")
