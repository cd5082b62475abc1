"""URL filter: host and path rules, each indexed by its rarest literal token.

The tokens of a URL (host labels, whole path segments) fetch the rules filed under them; only those rules' regular
expressions run. How rare a token is comes from counts over all URLs. The longest fitting rule decides; where none fits,
word patterns, indexed the same way, block unwanted hosts, and everything else is allowed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inciscope.llm.common import slices


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and all its subdomains if the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        return rf"(?:[^/]*\.)?{re.escape(self.host)}/{re.escape(self.path)}"

    @property
    def literals(self) -> list[str]:
        """Tokens that every URL the rule fits must have: host labels and path segments closed by a slash."""
        return [*self.host.split("."), *(s for s in self.path.split("/")[:-1] if s)]


#: The rules asked for.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
#: Host words that mark advertising and spam where no rule fits; a host label has one between its hyphens.
BLOCKED_WORDS = ("ads", "adserver", "banner", "casino", "doubleclick", "pills", "porn", "track", "tracker", "viagra")

PARTS = "page_id long, host string, path string"
VERDICTS = "page_id long, host string, path string, rule string, verdict string"


def split_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path). Null, or without ``://``: both empty."""
    url = F.coalesce(pages[url_col].cast("string"), F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return pages.select(pages[id_col].cast("long").alias("page_id"), rest.alias("rest")).select(
        "page_id",
        F.translate(F.regexp_extract("rest", r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("host"),
        F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path"),
    )


def literal_counts(parts: DataFrame, literals: Sequence[str]) -> dict[str, int]:
    """On how many URLs each literal of the rules is a token; as many rows as there are literals."""
    tokens = F.array_distinct(F.concat(F.split("host", r"\."), F.split("path", "/"), F.split("host", r"[.-]")))
    found = parts.select(F.explode(tokens).alias("token")).where(F.col("token").isin(sorted(set(literals))))
    return {r["token"]: r["count"] for r in found.groupBy("token").count().collect()}


def rule_index(rules: Sequence[Rule], counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Rules under the literal token that the fewest URLs have (ties: the longer, then the lesser token)."""
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        token = min(rule.literals, key=lambda t: (counts.get(t, 0), -len(t), t))
        index.setdefault(token, []).append(rule)
    return index


def judge(
    pages: DataFrame, rules: Sequence[Rule] = RULES, blocked_words: Sequence[str] = BLOCKED_WORDS,
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """One row for each row of ``pages``: host, path, the longest fitting rule (null if none) and the verdict.

    Of rules of one length the first given wins. Null urls and those without ``://`` fit no rule and are allowed.
    Repeated rows are judged one by one; other columns are not read.
    """
    parts = split_urls(pages, id_col, url_col)
    index = rule_index(rules, literal_counts(parts, [t for r in rules for t in r.literals]))
    order = {rule: k for k, rule in enumerate(rules)}
    words = frozenset(blocked_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = {rule: re.compile(rule.pattern, re.DOTALL) for rule in rules}
        word_patterns = {w: re.compile(rf"(?:^|[.-]){re.escape(w)}(?:[.-]|\Z)") for w in words}
        for batch in slices(batches, 10_000):
            chosen, verdicts = [], []
            for host, path in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                labels = host.split(".")
                candidates = {r for t in {*labels, *path.split("/")} for r in index.get(t, ())}
                text = f"{host}/{path}"  # a host has no slash
                fits = [r for r in candidates if patterns[r].match(text)]
                best = min(fits, key=lambda r: (-len(r.text), order[r]), default=None)
                chosen.append(best.text if best else None)
                if best:
                    verdicts.append(best.verdict)
                else:
                    hits = words.intersection(w for label in labels for w in label.split("-"))
                    verdicts.append("block" if any(word_patterns[w].search(host) for w in hits) else "allow")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(chosen, pa.string()), pa.array(verdicts, pa.string())],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    return parts.mapInArrow(run, VERDICTS)


def oracle() -> str:
    """The same verdicts from every rule tried on every URL."""
    rest = "CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
    lower = "translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    rows = ", ".join(f"({k}, '{r.verdict}', '{r.host}', '{r.path}')" for k, r in enumerate(RULES))
    words = "|".join(BLOCKED_WORDS)
    return f"""
        WITH rules(k, verdict, rule_host, rule_path) AS (VALUES {rows}),
        rests AS (SELECT page_id, {rest} AS rest FROM pages),
        parts AS (SELECT page_id, {lower} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
        fits AS (
            SELECT page_id, rule_host || rule_path AS rule, verdict,
                row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC, k) AS place
            FROM parts JOIN rules
                ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
        SELECT p.page_id, host, path, rule, CASE WHEN verdict IS NOT NULL THEN verdict
            WHEN regexp_matches(host, '(^|[.-])({words})([.-]|$)') THEN 'block' ELSE 'allow' END AS verdict
        FROM parts p LEFT JOIN fits f ON p.page_id = f.page_id AND place = 1"""
