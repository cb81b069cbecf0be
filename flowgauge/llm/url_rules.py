"""URL filter rules, fetched by their rarest literal token. DataFrame functions only.

A rule is a host and a path prefix such as ``example.com/en/``. It fits its host and all
subdomains, if the path of the url starts with the rule's. Each rule hangs under one token:
of the host labels and whole path segments that any fitting url must hold, the one that the
fewest urls hold. A url looks its own tokens up, and only the rules found run their
regular expression. The rule list is configuration, so it travels in the plan; no row is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str  # allow or block
    pattern: str  # host, then a path prefix that starts with /

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0].translate(str.maketrans(UPPER, LOWER))

    @property
    def path(self) -> str:
        return "".join(self.pattern.partition("/")[1:])

    @property
    def regex(self) -> str:
        return rf"^(?:[^/]*\.)?{_escaped(self.host)}{_escaped(self.path) or '(?:/|$)'}"

    @property
    def tokens(self) -> list[str]:
        """Literals that stand as whole tokens in every url that fits."""
        segments = self.path.split("/")[1:-1]  # the last may be the start of a longer one
        return [*(f"h:{label}" for label in self.host.split(".")), *(f"p:{part}" for part in segments if part)]


def _escaped(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9_/ -])", r"\\\1", text)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url and for one without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def url_tokens(host: Column, path: Column) -> Column:
    """Distinct host labels and path segments."""
    labels = F.transform(F.split(host, r"\."), lambda part: F.concat(F.lit("h:"), part))
    segments = F.transform(F.split(path, "/"), lambda part: F.concat(F.lit("p:"), part))
    return F.array_distinct(F.concat(labels, segments))


def token_counts(urls: DataFrame, tokens: Sequence[str]) -> dict[str, int]:
    """In how many urls each token of the rules stands; as many rows as the rules have tokens."""
    wanted = F.array(*[F.lit(token) for token in sorted(set(tokens))])
    host, path = host_and_path(F.col("url"))
    held = urls.select(F.explode(F.array_intersect(url_tokens(host, path), wanted)).alias("token"))
    return {row["token"]: row["count"] for row in held.groupBy("token").count().collect()}


def rule_index(rules: Sequence[Rule], counts: dict[str, int]) -> dict[str, list[Rule]]:
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        rarest = min(rule.tokens, key=lambda token: (counts.get(token, 0), token))
        index.setdefault(rarest, []).append(rule)
    return index


def judge_urls(pages: DataFrame, rules: Sequence[Rule], default: str = "allow") -> DataFrame:
    """One row per page: page_id, url, host, path, candidates, rule and verdict.

    The longest fitting rule decides; of two equally long, a block goes before an allow, then the
    smaller text. A url that no rule fits has a null rule and the default verdict. Null urls
    and urls without ``://`` have empty host and path. Repeated pages are judged each, and other columns are left out.
    """
    if not rules:
        raise ValueError("no rules")
    urls = pages.select("page_id", "url")
    index = rule_index(rules, token_counts(urls, [token for rule in rules for token in rule.tokens]))
    entries = []
    for token, own in sorted(index.items()):
        listed = [
            F.struct(
                F.lit(len(rule.pattern)).alias("length"),
                F.lit(int(rule.verdict == "block")).alias("blocks"),
                F.lit(rule.host + rule.path).alias("rule"),
                F.lit(rule.verdict).alias("verdict"),
                F.lit(rule.regex).alias("regex"),
            )
            for rule in own
        ]
        entries += [F.lit(token), F.array(*listed)]
    host, path = host_and_path(F.col("url"))
    split = urls.withColumns({"host": host, "path": path})
    by_token = F.create_map(*entries)
    known = F.array(*[F.lit(token) for token in sorted(index)])
    held = F.array_intersect(url_tokens(F.col("host"), F.col("path")), known)
    fetched = split.withColumn("fetched", F.flatten(F.transform(held, lambda token: by_token[token])))
    address = F.concat("host", "path")
    fitting = F.filter("fetched", lambda rule: F.regexp_like(address, rule["regex"]))
    order = lambda rule: F.struct(rule["length"], rule["blocks"], rule["rule"], rule["verdict"])
    judged = fetched.withColumn("best", F.array_max(F.transform(fitting, order)))
    return judged.select(
        "page_id",
        "url",
        "host",
        "path",
        F.size("fetched").alias("candidates"),
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
