"""URL filter: allow and block entries in a trie over reversed host labels and path segments.

A rule is a host and a path. It fits a url if the url's host is the rule's host or one of its subdomains and the
url's path starts with the rule's path. Of the rules that fit, the longest wins, counted in characters of host and
path together; of two that are equally long the one with the longer host, and of the same rule listed twice the
block.

The trie is built on the driver from the rule list, so its size follows the rules and not the urls. It is broadcast
up to `max_rules` rules; more are refused, as the list is then a table to join and not a filter.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendaria.llm.names import unused

ALLOW, BLOCK = "allow", "block"

#: A trie with so many rules takes a few hundred MB in each Python worker.
MAX_RULES = 500_000

VERDICT = T.StructType(
    [
        T.StructField("host", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("rule", T.StringType()),
        T.StructField("verdict", T.StringType()),
    ]
)

_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str = "/"


class _Node:
    """`children` by host label or path segment; `rules` that end here, by the start of the next segment they ask for."""

    __slots__ = ("children", "paths", "rules")

    def __init__(self):
        self.children: dict[str, _Node] = {}
        self.paths: _Node | None = None
        self.rules: dict[str, Rule] = {}

    def child(self, key: str) -> _Node:
        return self.children.setdefault(key, _Node())


def split_url(url: str | None) -> tuple[str, str]:
    """Host in lower case and path; both empty without a `://`."""
    if url is None:
        return "", ""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    for mark in "?#":
        rest = rest.partition(mark)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


class UrlTrie:
    """Host labels from the last to the first lead to a node; from there path segments lead on."""

    def __init__(self, rules: Iterable[Rule]):
        self._root = _Node()
        for rule in rules:
            if rule.verdict not in (ALLOW, BLOCK):
                raise ValueError(f"a rule allows or blocks, not {rule.verdict!r}")
            self._add(rule._replace(host=rule.host.translate(_LOWER)))

    def _add(self, rule: Rule) -> None:
        node = self._root
        for label in reversed(rule.host.split(".")):
            node = node.child(label)
        node.paths = node.paths or _Node()
        *segments, start = rule.path.split("/")
        node = node.paths
        for segment in segments:
            node = node.child(segment)
        if start not in node.rules or rule.verdict == BLOCK:
            node.rules[start] = rule

    def longest(self, host: str, path: str) -> Rule | None:
        """The rule that decides this url."""
        best, length = None, (-1, -1)
        node = self._root
        segments = path.split("/")
        for label in reversed(host.split(".")):
            node = node.children.get(label)
            if node is None:
                break
            if node.paths is not None:
                for rule in _along(node.paths, segments):
                    if (size := (len(rule.host) + len(rule.path), len(rule.host))) > length:
                        best, length = rule, size
        return best


def _along(node: _Node, segments: list[str]) -> Iterator[Rule]:
    for segment in segments:
        for start, rule in node.rules.items():
            if segment.startswith(start):
                yield rule
        node = node.children.get(segment)
        if node is None:
            return


def judge_urls(
    pages: DataFrame,
    rules: Iterable[Rule],
    url_col: str = "url",
    output: str = "url_verdict",
    default: str = ALLOW,
    max_rules: int = MAX_RULES,
) -> DataFrame:
    """Add the struct `output` (host, path, rule, verdict) to every row.

    Nothing is shuffled or dropped. A null url, or one without `://`, has an empty host and path. No rule fits an
    empty host; a url that no rule fits gets `default` and a null rule. Repeated rows are judged alike. An existing
    column called `output` is replaced, as by `withColumn`; other columns stay.
    """
    rules = list(rules)
    if len(rules) > max_rules:
        raise ValueError(f"{len(rules)} rules; at most {max_rules} are broadcast")
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    @F.pandas_udf(VERDICT)
    def judge(urls: pd.Series) -> pd.DataFrame:
        longest = trie.value.longest
        rows = []
        for url in urls:
            host, path = split_url(url)
            rule = longest(host, path)
            rows.append((host, path, rule and rule.host + rule.path, rule.verdict if rule else default))
        return pd.DataFrame(rows, columns=VERDICT.names)

    return pages.withColumn(output, judge(F.col(f"`{url_col}`").cast("string")))


def filter_urls(pages: DataFrame, rules: Iterable[Rule], url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """The rows whose url is allowed, with the columns they came with, whatever they are called.

    A url without a host, such as a null one, has the verdict `default`. Repeated rows are judged alike.
    """
    (own,) = unused(pages, "url_verdict")
    judged = judge_urls(pages, rules, url_col, own, default)
    return judged.filter(F.col(f"{own}.verdict") == ALLOW).drop(own)
