"""URL filtering: listed rules first, then association rules mined from labelled URLs.

A URL becomes a set of tokens: labels of the host, its endings, words of the path and query,
and marks for scheme and form. Spark's FP-growth mines frequent combinations of
tokens together with the label of the page. A combination that speaks for blocking
with enough support and confidence, and clearly more often than the average page, becomes a rule; one
that holds no more than a part of itself is dropped. Rules are indexed by the token that
is rarest among the labelled URLs, so a URL looks up few of them.

Mining goes through all combinations of the tokens that it is given, so it is given as few as can be
without losing a rule: only tokens that are frequent on pages to block; one for all tokens that
stand in the very same URLs, such as the words of one folder's path; and none that stand in all URLs,
nor one that means blocking by itself, as its combinations say no more. A rule holds whole sets of
equal tokens, and fits a URL with any token of each set.

Listed rules are (host, path) pairs; one fits its host and all subdomains where the path of the URL
starts with its path, and the longest one wins. A URL that no listed rule fits takes the verdict
of the mined rules, or is allowed.

The labels may be given by page. Without them the pages that listed rules decide are the labelled ones, and
the mined rules carry what is common to them over to the others.

Mined rules are a model: the tokens in them are bounded by the least support, not by the input, and a rule has
at most ``LONGEST`` sets.

Defined results: null, or a URL without ``://``, has an empty host and path and no tokens, and is
allowed; a page with several labels is bad if any is; without labels of both kinds nothing is
mined. Repeated rows are judged each on its own; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

LEAST_SUPPORT = 0.002  # of all labelled URLs, together with the label
LEAST_CONFIDENCE = 0.7
LEAST_GAIN = 0.5  # of the way from the share of all labelled URLs to certainty
LEAST_TRANSACTIONS = 20  # URLs that a rule rests on
LONGEST = 3  # tokens of a rule, equal ones counted once
LABEL = "label=block"


@dataclass(frozen=True)
class Listed:
    """A listed rule, written like ``example.net/en/``."""

    verdict: str
    rule: str

    @property
    def host(self) -> str:
        return self.rule.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.split("/", 1)[1]


def host_of(url: Column) -> Column:
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(after, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def listed_rule(host: Column, path: Column, rules: list[Listed]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for one in sorted(rules, key=lambda r: (len(r.rule), r.rule)):
        fits = ((host == one.host) | host.endswith("." + one.host)) & path.startswith(one.path)
        rule = F.when(fits, F.lit(one.rule)).otherwise(rule)
        verdict = F.when(fits, F.lit(one.verdict)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    """The distinct tokens of a URL, as Spark expressions."""
    host, path = host_of(url), path_of(url)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*(.*)$", 1)
    words = F.regexp_extract_all(F.lower(path), F.lit(r"[^/._\-]+"), F.lit(0))
    query = F.regexp_extract_all(F.lower(rest), F.lit(r"[?&#][^=&#]+"), F.lit(0))
    scheme = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(.*?)://", 1))
    ending = F.array_join(F.slice(labels, -2, 2), ".")
    marked = F.concat(
        F.transform(labels, lambda x: F.concat(F.lit("host="), x)),
        F.when(F.size(labels) >= 2, F.array(F.concat(F.lit("ending="), ending))).otherwise(
            F.array().cast("array<string>")
        ),
        F.transform(F.filter(words, lambda x: ~x.rlike("^[0-9]+$")), lambda x: F.concat(F.lit("path="), x)),
        F.transform(query, lambda x: F.concat(F.lit("query="), x)),
        F.array(F.concat(F.lit("scheme="), scheme)),
    )
    return F.when(F.coalesce(F.contains(url, F.lit("://")), F.lit(False)), F.array_distinct(marked)).otherwise(
        F.array().cast("array<string>")
    )


@dataclass(frozen=True)
class Mined:
    """``sets`` of equal tokens, of which a URL needs one each."""

    sets: tuple[tuple[str, ...], ...]
    confidence: float
    support: float

    @property
    def tokens(self) -> tuple[str, ...]:
        """The first token of each set."""
        return tuple(s[0] for s in self.sets)

    def held(self, own: set[str]) -> tuple[str, ...] | None:
        """The last token of each set that a URL has; None if it has none of some set."""
        of_sets = [[t for t in s if t in own] for s in self.sets]
        return tuple(sorted(h[-1] for h in of_sets)) if all(of_sets) else None


def mine(
    labelled: DataFrame,
    least_support: float = LEAST_SUPPORT,
    least_confidence: float = LEAST_CONFIDENCE,
    least_gain: float = LEAST_GAIN,
) -> tuple[list[Mined], dict[str, int]]:
    """Rules from rows with ``url`` and ``bad``, and how often their tokens occur."""
    rows = labelled.select(tokens(F.col("url")).alias("items"), "bad").where(F.size("items") > 0)
    totals = rows.agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("int")).alias("bad")).first()
    if not totals.n or not totals.bad or totals.bad == totals.n:
        return [], {}
    least = math.ceil(max(least_support * totals.n, LEAST_TRANSACTIONS) - 1e-6)
    share = totals.bad / totals.n
    needed = max(least_confidence, share + (1 - share) * least_gain)
    # Tokens of the very same URLs have the same counts and the same sum of the URLs' hashes.
    url_hash = F.xxhash64(F.array_sort("items")).cast("decimal(20,0)")
    frequent = (
        rows.select(F.explode("items").alias("token"), "bad", url_hash.alias("url"))
        .groupBy("token")
        .agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("int")).alias("bad"), F.sum("url").alias("urls"))
        .where(F.col("bad") >= least)
        .groupBy("n", "bad", "urls")
        .agg(F.array_sort(F.collect_list("token")).alias("tokens"))
        .collect()
    )
    seen = {token: row.n for row in frequent for token in row.tokens}
    sets = {row.tokens[0]: tuple(row.tokens) for row in frequent}
    certain = [row for row in frequent if row.bad == row.n]
    rules = [Mined((tuple(row.tokens),), 1.0, row.bad / totals.n) for row in certain]
    open_ones = [row.tokens[0] for row in frequent if row.bad < row.n < totals.n]
    if open_ones:
        kept = F.filter("items", lambda token: token.isin(open_ones))
        label = F.when(F.col("bad"), F.array(F.lit(LABEL))).otherwise(F.array().cast("array<string>"))
        model = FPGrowth(
            itemsCol="items", minSupport=(least - 0.5) / totals.n, minConfidence=min(1.0, needed)
        ).fit(rows.select(F.concat(kept, label).alias("items")))
        rules += [
            Mined(tuple(sets[t] for t in r.tokens), r.confidence, r.support)
            for r in model.associationRules.where(
                F.array_contains("consequent", LABEL) & (F.size("antecedent") <= LONGEST)
            )
            .select(F.array_sort("antecedent").alias("tokens"), "confidence", "support")
            .collect()
        ]
    confidence = {r.tokens: r.confidence for r in rules}
    best: list[Mined] = []
    for rule in sorted(rules, key=lambda r: (len(r.sets), r.tokens)):
        parts = (part for size in range(1, len(rule.sets)) for part in combinations(rule.tokens, size))
        if all(confidence.get(part, 0.0) < rule.confidence for part in parts):
            best.append(rule)
    return best, seen


def index(rules: list[Mined], seen: dict[str, int]) -> dict[str, list[Mined]]:
    """The rules by the tokens of their rarest set."""
    by: dict[str, list[Mined]] = {}
    for rule in rules:
        for token in min(rule.sets, key=lambda s: (seen.get(s[0], 0), s)):
            by.setdefault(token, []).append(rule)
    return by


def best_match(own: list[str], by: dict[str, list[Mined]]) -> tuple[tuple[str, ...], Mined] | None:
    """The most certain rule that fits, and the tokens by which it does."""
    held = set(own)
    fitting = [(tokens, r) for t in own for r in by.get(t, ()) if (tokens := r.held(held))]
    return max(fitting, key=lambda m: (m[1].confidence, m[1].support, m[0]), default=None)


def judge(pages: DataFrame, labels: DataFrame | None, listed: list[Listed]) -> DataFrame:
    """Every page's host, path, listed rule, verdict, and the mined rule that fits it if any.

    ``labels`` has page_id and bad; without it the listed rules label the pages that they decide.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    if labels is None:
        decided = listed_rule(host, path, listed)[1]
        labelled = pages.select("url", (decided == "block").alias("bad")).where("bad IS NOT NULL")
    else:
        given = labels.groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
        labelled = pages.select("page_id", "url").join(given, "page_id").select("url", (F.col("bad") > 0).alias("bad"))
    rules, seen = mine(labelled)
    by = index(rules, seen)
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        host.alias("host"),
        path.alias("path"),
        tokens(F.col("url")).alias("tokens"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matches = [best_match(own or [], by) for own in batch.column("tokens").to_pylist()]
            mined = pa.array([" & ".join(m[0]) if m else None for m in matches], pa.string())
            confidence = pa.array([m[1].confidence if m else None for m in matches], pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("host"), batch.column("path"), mined, confidence],
                ["page_id", "host", "path", "mined", "confidence"],
            )

    matched = rows.mapInArrow(
        run, "page_id bigint, host string, path string, mined string, confidence double"
    )
    rule, verdict = listed_rule(F.col("host"), F.col("path"), listed)
    return matched.select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("mined").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        "mined",
        "confidence",
    )
