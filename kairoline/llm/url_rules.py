"""URL filters: a trie over reversed host labels, then path segments.

The trie is shipped to the tasks; its size is bounded by ``max_rules``, which is checked before. A rule fits its host
and all subdomains if the path of the url starts with the rule's path; of all fitting rules the longest (host and path
together) decides, then the longer host, then a block over an allow.

Defined results: a null url, or one without ``://``, has an empty host and path and meets no rule; so has the path of
a url that ends at its host, unless a rule's path is empty. Without a rule the default verdict holds. Repeated rows
are judged each; input columns are kept, and the added ones are named by the caller.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kairoline.llm.common import col


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # "allow" or "block"

    @property
    def name(self) -> str:
        return self.host + self.path


def build_trie(rules: Iterable[Rule], max_rules: int = 2_000_000) -> dict:
    """Nested dicts. A node has children by label (``"h"``), children by path segment (``"p"``) and the rules that end
    inside its next segment (``"r"``: rest of the path, order key, name, verdict)."""
    root: dict = {}
    for n, rule in enumerate(rules):
        if n >= max_rules:
            raise ValueError(f"more than {max_rules} url rules; the trie would not be safe to broadcast")
        node = root
        for label in reversed(rule.host.split(".")):
            node = node.setdefault("h", {}).setdefault(label, {})
        *segments, rest = rule.path.split("/")
        for segment in segments:
            node = node.setdefault("p", {}).setdefault(segment, {})
        key = (len(rule.name), len(rule.host), rule.verdict == "block")
        node.setdefault("r", []).append((rest, key, rule.name, rule.verdict))
    return root


def longest_match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """Name and verdict of the deciding rule."""
    best = None
    segments = path.split("/")
    node = trie
    for label in reversed(host.split(".")):
        node = node.get("h", {}).get(label)
        if node is None:
            break
        below, at = node, 0
        while below is not None:
            # the rest of a rule's path must begin the unread path; segments before it were equal and ended by "/"
            for rest, key, name, verdict in below.get("r", ()):
                if segments[at].startswith(rest) and (best is None or key > best[0]):
                    best = (key, name, verdict)
            if at + 1 >= len(segments):
                break
            below = below.get("p", {}).get(segments[at])
            at += 1
    return best[1:] if best else None


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path columns."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    tail = F.when(at > 0, F.substr(u, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(tail, r"^([^/?#]*)", 1)
    path = F.regexp_extract(tail, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def judge_urls(pages: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow",
               names: tuple[str, str, str, str] = ("host", "path", "rule", "verdict")) -> DataFrame:
    """``pages`` with host, path, deciding rule (null: none) and verdict under the given names."""
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def decide(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        t = trie.value
        found = [longest_match(t, h, p) or (None, default) for h, p in zip(host, path, strict=True)]
        return pd.DataFrame(found, columns=["rule", "verdict"], dtype=object)

    host, path = host_and_path(col(url))
    kept = [col(c) for c in pages.columns if c not in names]
    judged = pages.select(*kept, host.alias(names[0]), path.alias(names[1]))
    out = decide(col(names[0]), col(names[1]))
    return judged.withColumn("_decided", out).select(
        "*", F.col("_decided.rule").alias(names[2]), F.col("_decided.verdict").alias(names[3])).drop("_decided")
