"""URL filters: host rules, and pattern rules that are found by their rarest literal token.

Everything is decided inside the row of the url: no shuffle, no join, no Python.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class HostRule:
    """Fits `host` and all its subdomains, if the path of the url starts with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    """A pattern for the whole url, with A-Z lower-cased.

    `*`: any characters; `^`: one character that is no letter, digit or one of `_.%-`, or the end;
    `|` at either end: start or end of the url; `||` at the start: start of the host or of one of its labels.
    """

    pattern: str
    verdict: str = "block"

    @property
    def body(self) -> str:
        return self.pattern.translate(str.maketrans(_UPPER, _LOWER))

    def regex(self) -> str:
        """The pattern as a regular expression that Java and RE2 read alike."""
        body, start, end = self.body, "", ""
        if body.startswith("||"):
            body, start = body[2:], r"^[^/?#]*://(?:[^/?#]*\.)?"
        elif body.startswith("|"):
            body, start = body[1:], "^"
        if body.endswith("|"):
            body, end = body[:-1], r"\z"
        parts = {"*": ".*", "^": r"(?:[^a-z0-9_.%-]|\z)"}
        quoted = (parts.get(c) or (c if c.isalnum() or c in "/_" else "\\" + c) for c in body)
        return "(?s)" + start + "".join(quoted) + end

    def tokens(self) -> set[str]:
        """Literal tokens that every url which the pattern fits must have as whole tokens."""
        body = self.body
        found = set()
        for match in re.finditer(_TOKEN, body):
            before, after = body[: match.start()], body[match.end() :]
            # A wildcard or an open end beside it could continue the token.
            if before and not before.endswith("*") and after and not after.startswith("*"):
                found.add(match.group())
        return found


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (after the first `://` up to `/`, `?`, `#` or end, A-Z lower-cased) and path (up to `?`, `#` or end)."""
    url = F.coalesce(url, F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(url, pattern, 1), _UPPER, _LOWER), F.regexp_extract(url, pattern, 2)


def _lower_url(url: Column) -> Column:
    return F.translate(F.coalesce(url, F.lit("")), _UPPER, _LOWER)


def _tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(_lower_url(url), F.lit(_TOKEN), F.lit(0)))


def token_counts(pages: DataFrame, tokens: list[str], url_column: str = "url") -> dict[str, int]:
    """In how many urls each of `tokens` occurs. At most that many rows reach the driver."""
    if not tokens:
        return {}
    wanted = F.array(*map(F.lit, tokens))
    hits = pages.select(F.explode(F.array_intersect(_tokens(F.col(url_column)), wanted)).alias("token"))
    counted = {row["token"]: row["n"] for row in hits.groupBy("token").agg(F.count("*").alias("n")).collect()}
    return {token: counted.get(token, 0) for token in tokens}


class RuleIndex:
    """Pattern rules under their rarest token. Rules without a safe token are tried on every url."""

    def __init__(self, rules: list[PatternRule], counts: dict[str, int]):
        self.by_token: dict[str, list[PatternRule]] = {}
        self.always: list[PatternRule] = []
        for rule in rules:
            tokens = rule.tokens()
            if tokens:
                rarest = min(tokens, key=lambda t: (counts.get(t, 0), -len(t), t))
                self.by_token.setdefault(rarest, []).append(rule)
            else:
                self.always.append(rule)

    @staticmethod
    def _literal(rules: list[PatternRule]) -> Column:
        return F.array(
            *(F.struct(F.lit(r.regex()).alias("regex"), F.lit(r.verdict == "allow").alias("allow")) for r in rules)
        )

    def candidates(self, url: Column) -> Column:
        """The rules that the tokens of a url fetch, as structs of regex and allow."""
        none = F.array().cast("array<struct<regex:string,allow:boolean>>")
        fetched = self._literal(self.always) if self.always else none
        if self.by_token:
            hits = F.array_intersect(_tokens(url), F.array(*map(F.lit, self.by_token)))
            pairs = [x for token, rules in self.by_token.items() for x in (F.lit(token), self._literal(rules))]
            index = F.create_map(*pairs)
            found = F.flatten(F.transform(hits, lambda token: F.try_element_at(index, token)))
            fetched = F.when(F.size(hits) > 0, F.concat(fetched, found)).otherwise(fetched)
        return fetched

    def verdict(self, url: Column) -> Column:
        """An exception that fits allows; else a blocking rule that fits blocks; else the url is allowed."""
        lower = _lower_url(url)
        fitting = F.transform(
            F.filter(self.candidates(url), lambda rule: F.regexp(lower, rule["regex"])), lambda rule: rule["allow"]
        )
        blocked = (F.size(fitting) > 0) & ~F.exists(fitting, lambda allow: allow)
        return F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))


def judge_urls(
    pages: DataFrame,
    host_rules: list[HostRule],
    pattern_rules: list[PatternRule],
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """One row per row of `pages`: id, host, path, rule (the longest host rule that fits, or null) and verdict.

    The verdict is that of the host rule, else that of the pattern rules. A null url, or one without `://`, has an
    empty host and path; pattern rules still see its text. Repeated rows are judged alike, null ids are kept, and
    other columns are ignored. An empty table gives an empty result.
    """
    url = F.col(url_column)
    tokens = sorted(set().union(*(rule.tokens() for rule in pattern_rules)) if pattern_rules else set())
    index = RuleIndex(pattern_rules, token_counts(pages, tokens, url_column))
    host, path = split_url(url)
    parts = pages.select(
        F.col(id_column), host.alias("host"), path.alias("path"), index.verdict(url).alias("_method")
    )
    rule = verdict = None
    for each in sorted(host_rules, key=lambda r: (-len(r.text), r.text)):
        of_host = (F.col("host") == each.host) | F.endswith("host", F.lit("." + each.host))
        fits = of_host & F.startswith("path", F.lit(each.path))
        rule = F.when(fits, F.lit(each.text)) if rule is None else rule.when(fits, F.lit(each.text))
        verdict = F.when(fits, F.lit(each.verdict)) if verdict is None else verdict.when(fits, F.lit(each.verdict))
    return parts.select(
        id_column,
        "host",
        "path",
        (F.lit(None).cast("string") if rule is None else rule).alias("rule"),
        (F.col("_method") if verdict is None else verdict.otherwise(F.col("_method"))).alias("verdict"),
    )
