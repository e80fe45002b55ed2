"""URL filter: a broadcast trie over reversed host labels, then path segments.

Each rule names a host and a path prefix and says allow or block.  A rule fits
the host itself and all its subdomains when the URL's path starts with the
rule's path.  The longest fitting rule wins: more host labels first, then the
longer path; between an allow and a block entry of the very same host and path,
block wins.  Without a fitting rule the verdict is ``default``.

Edge cases: a null URL, or one without ``://``, has an empty host and an empty
path and gets the default.  An empty table gives an empty result.  Repeated
rows are judged one by one.  Columns of the input are kept; outputs whose names
clash replace the input's columns.  URLs of any length are judged whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formmart.llm.common import ascii_lower

#: Bound of the broadcast rule set; a longer list is refused, never cut.
MAX_RULES = 200_000

VERDICT_TYPE = T.StructType([T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])


@dataclass(frozen=True)
class Rule:
    action: str  # allow or block
    host: str    # "net", "example.org"; "" fits every host
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


class UrlTrie:
    """Nodes are dictionaries: host labels from the right, then whole path segments.

    A rule's path ends in the node of its last whole segment, under the text
    that follows the last slash (empty for a path that ends in a slash).
    """

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {"labels": {}, "paths": None}
        for rule in rules:
            self._insert(rule)

    def _insert(self, rule: Rule) -> None:
        if rule.action not in ("allow", "block"):
            raise ValueError(f"a rule allows or blocks, got {rule.action!r}")
        node = self.root
        for label in reversed(rule.host.lower().split(".")) if rule.host else ():
            node = node["labels"].setdefault(label, {"labels": {}, "paths": None})
        node["paths"] = at = node["paths"] or {"next": {}, "tails": {}}
        *whole, tail = rule.path.split("/")
        for segment in whole:
            at = at["next"].setdefault(segment, {"next": {}, "tails": {}})
        known = at["tails"].get(tail)
        if known is None or rule.action == "block":
            at["tails"][tail] = rule

    @staticmethod
    def _longest_path(paths: dict, segments: list[str]) -> Rule | None:
        best, at = None, paths
        for i, segment in enumerate(segments):
            fits = [t for t in at["tails"] if segment.startswith(t)]
            if fits:
                best = at["tails"][max(fits, key=len)]
            # only a segment that a slash follows is whole
            at = at["next"].get(segment) if i + 1 < len(segments) else None
            if at is None:
                break
        return best

    def find(self, host: str, path: str) -> Rule | None:
        """The longest rule that fits, or None."""
        segments = path.split("/")
        node = self.root
        best = self._longest_path(node["paths"], segments) if node["paths"] else None
        for label in reversed(host.split(".")) if host else ():
            node = node["labels"].get(label)
            if node is None:
                break
            if node["paths"]:
                best = self._longest_path(node["paths"], segments) or best
        return best


def host_of(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark, hash or the end; A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """What follows the host, up to a question mark, a hash or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))


def filter_urls(df: DataFrame, rules: Iterable[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """The frame with host, path, rule and verdict of each URL (see the module's text)."""
    rules = list(rules)
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the broadcast trie holds {MAX_RULES} at most")
    trie = df.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    @F.pandas_udf(VERDICT_TYPE)
    def judge(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        find = trie.value.find
        for hosts, paths in batches:
            found = [find(h, p) for h, p in zip(hosts, paths)]
            yield pd.DataFrame({"rule": [r.name if r else None for r in found],
                                "verdict": [r.action if r else default for r in found]}, dtype=object)

    out = {"host": host_of(F.col(url)), "path": path_of(F.col(url))}
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (*out, "rule", "verdict")]
    judged = df.select(*kept, *[v.alias(k) for k, v in out.items()]).withColumn("_judged", judge("host", "path"))
    return judged.select("*", "_judged.rule", "_judged.verdict").drop("_judged")
