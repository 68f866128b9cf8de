"""URL filters: pattern rules indexed by their rarest literal token.

A pattern that matches must contain its literal tokens, so one of them is enough to find it.
The token that is rarest over all urls is chosen; the tokens of a url fetch candidate rules,
and only those run their regular expressions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The index is built in every task, so the number of rules is bounded.
RULES_MOST = 200_000
TOKEN = re.compile(r"[a-z0-9]+")

# Words that the method itself blocks, as whole tokens of host or path.
BLOCKED_WORDS = (
    "ads adserver advert banner doubleclick tracker pixel casino poker betting porn xxx sex "
    "escort warez torrent crack keygen login signin signup logout cart checkout"
).split()


_FOLD = str.maketrans(ascii_uppercase, ascii_lowercase)


@dataclass(frozen=True)
class Rule:
    """`pattern` is searched in host + path; `tokens` are literals that every match contains
    as whole tokens. Of matching rules with a rank, the highest wins; the rest come after."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int = 0


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits the host and its subdomains if the path begins with `path`."""
    literal = f"{host}{path}"
    whole = TOKEN.findall(literal.translate(_FOLD))
    if literal and literal[-1].isalnum():
        whole = whole[:-1]  # may continue in the url
    return Rule(
        literal.removesuffix("/") + "/", verdict,
        rf"^(?:[^/]*\.)?{re.escape(literal)}", tuple(whole), len(literal),
    )


def word_rule(word: str) -> Rule:
    """Contains the word between characters that are no ASCII letter or digit. Only A-Z and
    a-z are the same; other letters, such as the long s or the Kelvin sign, stand for
    themselves and end a word."""
    pattern = rf"(?:^|[^A-Za-z0-9])(?ai:{re.escape(word)})(?:[^A-Za-z0-9]|$)"
    return Rule(word, "block", pattern, (word.translate(_FOLD),))


WORD_RULES = tuple(map(word_rule, BLOCKED_WORDS))


def _lower(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(_rest(url), "^([^/?#]*)", 1)
    return F.coalesce(_lower(found), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url)))


def _tokens(where: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(_lower(where), F.lit("[a-z0-9]+"), F.lit(0)))


def judge(urls: DataFrame, rules: list[Rule], url_col: str = "url") -> DataFrame:
    """`urls` with host, path, rule and verdict.

    Of the matching rules with a rank, the highest wins (ties: the smallest name) and names
    itself in `rule`. Otherwise `rule` is null and the verdict is block if any rule without a
    rank matches, else allow. Null urls and urls without `://` have empty host and path and
    match nothing. Repeated rows are judged alike; other columns are kept, those named like a
    result are replaced.
    """
    if len(rules) > RULES_MOST:
        raise ValueError(f"more than {RULES_MOST} rules")
    parts = urls.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    where = F.concat("host", "path")
    wanted = sorted({t for r in rules for t in r.tokens})
    counted = (
        parts.select(F.explode(_tokens(where)).alias("token"))
        .where(F.col("token").isin(wanted) if len(wanted) <= 1000 else F.lit(True))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )
    times = {r.token: r.n for r in counted.collect()} if len(wanted) <= 1000 else {
        r.token: r.n
        for r in counted.join(
            urls.sparkSession.createDataFrame([(t,) for t in wanted], "token string"), "token"
        ).collect()
    }
    index: dict[str | None, list[Rule]] = {}
    for rule in rules:
        rarest = min(rule.tokens, key=lambda t: (times.get(t, 0), t), default=None)
        index.setdefault(rarest, []).append(rule)
    found = _matcher(index)(where, _tokens(where))
    return (
        parts.withColumn("found", found)
        .withColumns({"rule": F.col("found.rule"), "verdict": F.col("found.verdict")})
        .drop("found")
    )


@cache
def _compiled(pattern: str) -> re.Pattern:
    """Once in each worker; as many as there are rules."""
    return re.compile(pattern)


def _matcher(index: dict[str | None, list[Rule]]):
    kind = T.StructType(
        [T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())]
    )

    @F.arrow_udf(kind)
    def match(where: pa.Array, tokens: pa.Array) -> pa.Array:
        rules, verdicts = [], []
        for text, own in zip(where.to_pylist(), tokens.to_pylist()):
            hits = [
                r
                for token in (None, *own)
                for r in index.get(token, ())
                if _compiled(r.pattern).search(text)
            ]
            ranked = min((r for r in hits if r.rank), key=lambda r: (-r.rank, r.name), default=None)
            rules.append(ranked.name if ranked else None)
            verdicts.append(ranked.verdict if ranked else "block" if hits else "allow")
        return pa.StructArray.from_arrays(
            [pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], ["rule", "verdict"]
        )

    return match
