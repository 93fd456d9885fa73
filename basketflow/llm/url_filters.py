"""URL verdicts by host rules and by patterns that are indexed by a literal token.

A pattern implies literal tokens that any URL it matches must hold; they are read off the
parsed regular expression.  How often each of those tokens occurs is counted over all URLs; a pattern is filed under its
rarest one.  A URL's tokens fetch the patterns filed under them, and only those
run as regular expressions.  With tokens that are rare, the cost of a URL does not
grow with the list of rules.

The list of rules is a parameter of bounded size and goes to all tasks; judging
is then one narrow pass over the URLs, so a host with a third of all rows needs
no care.
"""

from __future__ import annotations

import re
import re._constants as codes
import re._parser as parser
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: More rules than this are refused, as each task holds them all.
MAX_RULES = 200_000

#: Tokens of a URL in lower case: runs of letters and digits.
TOKEN = r"[a-z0-9]+"
TOKEN_CHARACTER = re.compile(r"[a-z0-9]")


def implied_tokens(pattern: str) -> tuple[str, ...]:
    """The whole tokens that every match of a pattern holds, in order.

    A token is a run of letters and digits of the pattern itself, with something on
    either side that can only be another character, or the end of the URL.
    """
    items = list(parser.parse(pattern))
    found, at = [], 0
    while at < len(items):
        end = at
        while end < len(items) and items[end][0] is codes.LITERAL and TOKEN_CHARACTER.fullmatch(chr(items[end][1])):
            end += 1
        if end > at and _apart(items[:at], -1) and _apart(items[end:], 0):
            found.append("".join(chr(value) for _, value in items[at:end]))
        at = max(end, at + 1)
    return tuple(dict.fromkeys(found))


def _apart(items: list, side: int) -> bool:
    """Whether all that ``items`` match has, at its end (-1) or its beginning (0), no token's
    character: some other one, or the border of the URL."""
    if not items:
        return False
    code, value = items[side]
    others = items[:-1] if side else items[1:]
    if code is codes.LITERAL:
        return not TOKEN_CHARACTER.fullmatch(chr(value))
    if code is codes.IN:
        # Classes that are given by what they hold, as those given by what they don't hold tokens.
        return all(kind is codes.LITERAL and not TOKEN_CHARACTER.fullmatch(chr(c)) for kind, c in value)
    if code is codes.AT:
        return value in (codes.AT_BEGINNING, codes.AT_BEGINNING_STRING) if side else value is codes.AT_END_STRING or value is codes.AT_END
    if code is codes.SUBPATTERN:
        return _apart([*others, *value[3]] if side else [*value[3], *others], side)
    if code is codes.BRANCH:
        return all(_apart([*others, *branch] if side else [*branch, *others], side) for branch in value[1])
    if code is codes.MAX_REPEAT or code is codes.MIN_REPEAT:
        least, _, inner = value
        once = _apart(list(inner), side)
        return once and (least > 0 or _apart(others, side))
    return False


@dataclass(frozen=True)
class HostRule:
    """``rule`` is a host (which stands for its subdomains too) and the start of a path."""

    rule: str
    verdict: str


@dataclass(frozen=True)
class PatternRule:
    """``pattern`` runs on the URL in lower case.

    ``tokens``: whole tokens it implies, all of them if none are given; one that it does
    not imply is refused.  ``priority``: of patterns that match, the highest decides; of
    equals, allow.
    """

    pattern: str
    tokens: tuple[str, ...] | None = None
    verdict: str = "block"
    priority: int = 0

    def __post_init__(self) -> None:
        implied = implied_tokens(self.pattern)
        if self.tokens is None:
            object.__setattr__(self, "tokens", implied)
        elif wrong := set(self.tokens).difference(implied):
            raise ValueError(f"{self.pattern} does not imply the tokens {', '.join(sorted(wrong))}")


#: The host rules.
HOST_RULES = (
    HostRule("net/", "block"),
    HostRule("example.net/en/", "allow"),
    HostRule("example.com/de/", "block"),
    HostRule("org/fr/", "allow"),
)

#: What stands for what in a line of a filter list.
LIST_SIGNS = {"*": r"[^\n]*", "^": r"(?:[^a-z0-9_.%-]|$)"}


def listed_rule(line: str) -> PatternRule | None:
    """The rule of a line of a filter list; None for blank lines, comments and headings.

    ``||host`` begins at a host or a subdomain, ``|`` stands for the URL's beginning or end,
    ``*`` for anything, ``^`` for a separator or the end, ``@@`` before a rule allows, with
    a higher priority.  Rules with options, or as regular expressions, are refused.
    """
    line = line.strip()
    if not line or line[0] in "![" or line.startswith("#"):
        return None
    allow = line.startswith("@@")
    body = line.removeprefix("@@").lower()
    if "$" in body or "##" in body or (len(body) > 1 and body[0] == body[-1] == "/"):
        raise ValueError(f"no rule of this kind is read: {line}")
    start = r"^[a-z]+://(?:[^/?#]*\.)?" if body.startswith("||") else "^" if body.startswith("|") else ""
    end = r"$" if body.endswith("|") else ""
    inner = body.removeprefix("||").removeprefix("|").removesuffix("|")
    pattern = start + "".join(LIST_SIGNS.get(c) or re.escape(c) for c in inner) + end
    return PatternRule(pattern, verdict="allow" if allow else "block", priority=int(allow))


def read_rules(spark: SparkSession, path: str) -> tuple[PatternRule, ...]:
    """The rules of filter lists, at most ``MAX_RULES`` lines."""
    lines = [row["value"] for row in spark.read.text(path).limit(MAX_RULES + 1).collect()]
    if len(lines) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    return tuple(rule for rule in map(listed_rule, lines) if rule is not None)


#: Pattern rules for gambling, pills, tracking and adult hosts.  What
#: no pattern matches is allowed.
PATTERN_RULES = (
    PatternRule(r"://([^/?#]*[.-])?casino[.-]", ("casino",)),
    PatternRule(r"://([^/?#]*[.-])?free-bets[.-]", ("free", "bets")),
    PatternRule(r"://([^/?#]*[.-])?poker[.-]", ("poker",)),
    PatternRule(r"://([^/?#]*[.-])?cheap-pills[.-]", ("cheap", "pills")),
    PatternRule(r"://([^/?#]*[.-])?viagra[.-]", ("viagra",)),
    PatternRule(r"://([^/?#]*[.-])?ads-track[.-]", ("ads", "track")),
    PatternRule(r"://([^/?#]*\.)?ad\.doubleclick\.", ("ad", "doubleclick")),
    PatternRule(r"://([^/?#]*[.-])?xxx[.-]", ("xxx",)),
    PatternRule(r"://([^/?#]*[.-])?porn[.-]", ("porn",)),
    PatternRule(r"/ads/[^?#]*\.(js|gif)([?#]|$)", ("ads",)),
    PatternRule(r"[?&]click_?id=[^&#]+&([^#]*&)?aff(iliate)?_?id=", ()),
)


def lower_ascii(value: Column) -> Column:
    """A-Z in lower case; other letters stay."""
    return F.translate(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def token_counts(urls: DataFrame, tokens: list[str]) -> dict[str, int]:
    """In how many rows each of the given tokens occurs: a row per token at most."""
    found = F.array_distinct(F.regexp_extract_all(lower_ascii(F.col("url")), F.lit(f"({TOKEN})")))
    rows = (
        urls.select(F.explode(found).alias("token")).where(F.col("token").isin(tokens)).groupBy("token").count()
    )
    return dict.fromkeys(tokens, 0) | {row["token"]: row["count"] for row in rows.collect()}


def index(rules: tuple[PatternRule, ...], counts: dict[str, int]) -> dict[str, list[int]]:
    """Rules by their rarest token; those without tokens, under "", run on every URL."""
    by_token: dict[str, list[int]] = {}
    for number, rule in enumerate(rules):
        rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default="")
        by_token.setdefault(rarest, []).append(number)
    return by_token


class Judge:
    """Verdicts on single URLs."""

    def __init__(self, host_rules: tuple[HostRule, ...], rules: tuple[PatternRule, ...], by_token: dict):
        self.paths: dict[str, list[tuple[str, HostRule]]] = {}
        for rule in host_rules:
            host, slash, path = rule.rule.partition("/")
            self.paths.setdefault(host, []).append((slash + path, rule))
        self.rules = rules
        self.by_token = by_token
        self.token = re.compile(TOKEN)
        self.compiled = {n: re.compile(rules[n].pattern) for own in by_token.values() for n in own}
        self.lower = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

    def host_rule(self, host: str, path: str) -> HostRule | None:
        best = None
        while True:
            for start, rule in self.paths.get(host, ()):
                if path.startswith(start) and (best is None or len(rule.rule) > len(best.rule)):
                    best = rule
            dot = host.find(".")
            if dot < 0:
                return best
            host = host[dot + 1 :]

    def by_pattern(self, url: str) -> str:
        url = url.translate(self.lower)
        tokens = {"", *self.token.findall(url)}
        candidates = {n for t in tokens for n in self.by_token.get(t, ())}
        hits = [self.rules[n] for n in candidates if self.compiled[n].search(url)]
        return max(hits, key=lambda r: (r.priority, r.verdict == "allow")).verdict if hits else "allow"


def judge_urls(
    pages: DataFrame,
    host_rules: tuple[HostRule, ...] = HOST_RULES,
    rules: tuple[PatternRule, ...] = PATTERN_RULES,
) -> DataFrame:
    """``page_id, host, path, rule, verdict``, one row per row of ``pages``.

    A host rule decides first, the longest if several fit; else the patterns do.  A
    null URL, or one without ``://``, has an empty host and path and fits no host
    rule; a null URL matches no pattern and is allowed.  Columns other than
    ``page_id`` and ``url`` are not read.
    """
    if len(host_rules) + len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    urls = pages.select(F.col("page_id"), F.col("url").cast("string").alias("url"))
    tokens = sorted({t for rule in rules if len(rule.tokens) > 1 for t in rule.tokens})
    by_token = index(rules, token_counts(urls, tokens) if tokens else {})
    machine = pages.sparkSession.sparkContext.broadcast((host_rules, rules, by_token))

    @F.pandas_udf("rule string, verdict string")
    def verdicts(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        judge = Judge(*machine.value)
        for url, host, path in batches:
            found = [judge.host_rule(h, p) for h, p in zip(host, path, strict=True)]
            yield pd.DataFrame(
                {
                    "rule": [r.rule if r else None for r in found],
                    "verdict": [
                        r.verdict if r else judge.by_pattern(u or "") for r, u in zip(found, url, strict=True)
                    ],
                },
                dtype=object,
            )

    parts = urls.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = parts.withColumn("found", verdicts("url", "host", "path"))
    return judged.select("page_id", "host", "path", "found.rule", "found.verdict")
