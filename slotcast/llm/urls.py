"""URL filters: pattern rules indexed by their rarest literal token (DataFrame only)."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast.session import stage

from .common import lower_ascii

TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class UrlRule:
    """One rule.

    ``pattern``: ``||`` at the start anchors at the host or one of its parent domains, ``*``
    stands for any characters, ``^`` for one that is no letter, digit or ``_ . % -`` or for
    the end; everything else is literal.  ``action`` is allow or block.  Of the rules that
    fit, the highest ``level`` wins, then the longest ``name``, then allow before block.
    """

    name: str
    action: str
    pattern: str
    level: int = 0
    any_case: bool = True

    def regex(self) -> str:
        body, head = self.pattern, ""
        if body.startswith("||"):
            body, head = body[2:], "^(?:[^/?#]*\\.)?"
        parts = []
        for piece in re.split(r"([*^])", body):
            parts.append(
                {"*": ".*", "^": "(?:[^a-z0-9_.%-]|$)"}.get(piece)
                or re.sub(r"([^\w/ -])", r"\\\1", piece, flags=re.ASCII)
            )
        return ("(?is)" if self.any_case else "(?s)") + head + "".join(parts)

    def tokens(self) -> list[str]:
        """Literal tokens that every fitting URL holds whole: bounded on both sides."""
        body = self.pattern.removeprefix("||")
        anchored = body != self.pattern
        found = []
        for m in re.finditer(TOKEN, body.lower()):
            left = anchored if m.start() == 0 else body[m.start() - 1] != "*"
            right = m.end() < len(body) and body[m.end()] != "*"
            if left and right:
                found.append(m[0])
        return sorted(set(found))


def host_rule(action: str, where: str) -> UrlRule:
    """A host with its subdomains and a path prefix; letter case of the path counts."""
    return UrlRule(where, action, "||" + where, level=1, any_case=False)


#: Rules on hosts and paths; they outrank the patterns below.
HOST_RULES = (
    host_rule("allow", "org/"),
    host_rule("block", "example.org/es/"),
    host_rule("block", "example.org/en/1"),
    host_rule("allow", "com/fr/"),
    host_rule("block", "com/de/"),
)

#: Advertising, betting, adult, shop and account pages, and files that hold no prose.
PATTERNS = tuple(
    UrlRule(p, "block", p)
    for p in (
        "||ads.*^", "||ad.*^", "||adserver.", "||ads-track.", "||doubleclick.net^", "-track.", "/banner/",
        "/popunder/", "||casino.", "-casino.", "-bets.", "||bets.", "||poker.", "/poker/",
        "||porn.", "||xxx.", "-xxx.", ".xxx/", "/viagra/", "/login^", "/signin^", "/cart^", "/checkout^",
        ".zip^", ".exe^", ".mp4^", ".jpg^", ".png^",
    )
) + (UrlRule("/checkout/docs/", "allow", "/checkout/docs/", level=0),)


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and the text that rules are tried on (host, path, query).

    Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; path: from
    there up to ``? #`` or the end.  Null, or no ``://``: empty.
    """
    host = F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))
    query = F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^?#]*([^#]*)", 1), F.lit(""))
    return lower_ascii(host), path, F.concat(lower_ascii(host), path, query)


def _tokens(target: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(lower_ascii(target), F.lit(TOKEN), F.lit(0)))


def _rule_table(spark: SparkSession, rules: list[UrlRule]) -> DataFrame:
    """(rule_id, name, action, level, regex, tokens) from the given list."""
    rows = [
        F.struct(
            F.lit(i).alias("rule_id"), F.lit(r.name).alias("name"), F.lit(r.action).alias("action"),
            F.lit(r.level).alias("level"), F.lit(r.regex()).alias("regex"),
            F.array(*map(F.lit, r.tokens())).cast("array<string>").alias("tokens"),
        )
        for i, r in enumerate(rules)
    ]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def rule_index(targets: DataFrame, rules: DataFrame) -> DataFrame:
    """Each rule under its rarest token, counted over all distinct URLs."""
    wanted = rules.select("rule_id", F.explode("tokens").alias("token"))
    seen = (
        targets.select(F.explode(_tokens(F.col("target"))).alias("token"))
        .join(wanted.select("token").distinct(), "token")
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )
    chosen = (
        wanted.join(seen, "token", "left")
        .groupBy("rule_id")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token"))
    )
    return rules.drop("tokens").join(chosen, "rule_id")


def filter_urls(
    pages: DataFrame,
    rules: list[UrlRule] | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, pattern): one row for each row of ``pages``.

    Every distinct URL is judged once: its tokens fetch the rules indexed under them, and
    only those rules' regular expressions run.  Rules without a bounded token run on every
    URL as one column expression.  ``rule`` names the winning host rule, ``pattern`` the
    winning pattern where no host rule fits; with neither, the verdict is ``default``.

    The rule side of the token join is broadcast only where Spark's own size limit allows;
    else it is a sort-merge join whose hot tokens AQE splits.

    Defined cases: a null or empty URL, or one without ``://``, has empty parts and gets the
    default; repeated rows each give a row; a null id stays null; an empty table gives an
    empty result; other columns are not read.
    """
    rules = list(HOST_RULES + PATTERNS if rules is None else rules)
    host, path, target = parts(F.col(url_col))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"), target.alias("target")
    )
    targets = stage(rows.select("target").distinct())
    listed = _rule_table(pages.sparkSession, rules)
    index = stage(rule_index(targets, listed.where(F.size("tokens") > 0)))
    hit = ["level", "name", "action"]
    found = (
        targets.select("target", F.explode(_tokens(F.col("target"))).alias("token"))
        .join(index, "token")
        .where(F.expr("regexp_like(target, regex)"))
        .select("target", *hit)
    )
    loose = [r for r in rules if not r.tokens()]
    if loose:
        tried = F.array(
            *[
                F.when(
                    F.col("target").rlike(r.regex()),
                    F.struct(F.lit(r.level).alias("level"), F.lit(r.name).alias("name"), F.lit(r.action).alias("action")),
                )
                for r in loose
            ]
        )
        found = found.union(
            targets.select("target", F.explode(F.filter(tried, lambda x: x.isNotNull())).alias("x")).select("target", "x.*")
        )
    order = F.struct("level", F.length("name").alias("size"), (F.col("action") == "allow").alias("allow"), "name", "action")
    best = found.groupBy("target").agg(F.max(order).alias("best"))
    by_host = F.col("best.level") >= 1
    return rows.join(best, "target", "left").select(
        "page_id",
        "host",
        "path",
        F.when(by_host, F.col("best.name")).alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
        F.when(~by_host, F.col("best.name")).alias("pattern"),
    )
