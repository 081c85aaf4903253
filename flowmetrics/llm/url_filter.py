"""Verdicts on page addresses: rules by host and path, carried over to aliases of what they name.

Redirects, canonical links and refreshes make two addresses one; the components of these links are
found by joins. An address that a rule fits has the rule's verdict. Any other is blocked if an
alias of it is blocked and none is allowed: an explicit allow comes first. All of it is DataFrame
functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmetrics.llm.columns import apart, together
from flowmetrics.llm.components import connected_components
from flowmetrics.sources.scratch import scratch_path, written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The word may stand anywhere in the list of a rel, which without quotes is one word.
_LINK = (
    r"""(?is)<link\b(?=[^>]*(?<![\w-])rel\s*=\s*(?:"(?:[^">]*\s)?canonical[\s"]|'(?:[^'>]*\s)?canonical[\s']"""
    r"""|canonical[\s/>]))[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
)
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\burl\s*=\s*["']?([^"'\s>]+)"""


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none or the address is NULL."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """Up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def address_of(url: Column) -> Column:
    """What aliases are told by: host, path and query, not scheme or fragment; NULL without host."""
    rest = F.regexp_extract(_after_scheme(url), "^[^/?#]*([^#]*)", 1)
    slash = F.when(F.startswith(rest, F.lit("/")), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(host_of(url) != "", F.concat(host_of(url), slash))


def rules_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``rule_host``, ``rule_path``, ``rule_verdict`` (allow or block)."""
    return spark.createDataFrame(rules, "rule_host string, rule_path string, rule_verdict string")


def matched_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``host``, ``path`` of ``places`` that a rule fits, with ``rule``, ``rule_verdict``.

    A rule fits its host and all below it if the path begins with the rule's. The longest rule
    wins, by host, then by path; of the same one twice, allow. Rules are found by equality on
    each of a host's suffixes, so neither side is compared with all of the other.
    """
    distinct = places.select("host", "path").where("host <> ''").distinct()
    labels = F.split("host", "\\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    tried = distinct.select("host", "path", F.explode(suffixes).alias("rule_host"))
    fits = tried.join(rules, "rule_host").where(F.startswith("path", F.col("rule_path")))
    weight = F.struct(
        F.length("rule_host"), F.length("rule_path"), F.when(F.col("rule_verdict") == "allow", 1).otherwise(0)
    )
    best = F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "rule_verdict"), weight)
    return fits.groupBy("host", "path").agg(best.alias("best")).select(
        "host", "path", "best.rule", "best.rule_verdict"
    )


def page_links(pages: DataFrame) -> DataFrame:
    """Pairs ``url``, ``target`` of all canonical links and refreshes in ``html``.

    Targets without a scheme are taken from the page's own; NULL pages and addresses give none.
    """
    linked = pages.where(F.col("html").rlike("(?i)canonical|http-equiv"))
    found = linked.select(
        "url",
        F.explode(
            F.concat(
                F.regexp_extract_all("html", F.lit(_LINK), 1),
                F.regexp_extract_all("html", F.lit(_REFRESH), 1),
            )
        ).alias("to"),
    ).where("to <> '' AND url IS NOT NULL")
    scheme = F.regexp_extract("url", "^[^:/?#]*:", 0)
    host = F.concat(scheme, F.lit("//"), host_of(F.col("url")))
    folder = F.regexp_replace(path_of(F.col("url")), "[^/]*$", "")
    target = (
        F.when(F.instr(F.col("to"), "://") > 0, F.col("to"))
        .when(F.startswith("to", F.lit("//")), F.concat(scheme, F.col("to")))
        .when(F.startswith("to", F.lit("/")), F.concat(host, F.col("to")))
        .otherwise(F.concat(host, F.when(folder == "", "/").otherwise(folder), F.col("to")))
    )
    return found.select("url", target.alias("target"))


def judged_pages(
    pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, default: str = "allow"
) -> DataFrame:
    """All rows and columns of ``pages`` with ``host``, ``path``, ``rule`` (or NULL), ``verdict``.

    ``pages`` has ``url`` and ``html``; ``redirects``, if given, ``url`` and ``target``. Addresses
    that are NULL or lack a scheme have no host, no rule and no alias, so they get the default,
    as does every address that neither a rule nor an alias decides. Repeated rows are all judged.
    Columns named like the new ones are replaced.

    Only links are walked, by :func:`connected_components`; pages are read once for their links
    and once for their addresses, and joined to rules and to decided components by equality.
    """
    spark = pages.sparkSession
    links = page_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("url", "target"))
    links = links.where("url IS NOT NULL AND target IS NOT NULL")
    links = written(links, scratch_path(spark, "page-links"))
    url, target = F.col("url"), F.col("target")
    edges = links.select(address_of(url).alias("u"), address_of(target).alias("v"))
    joined = connected_components(edges.where("u IS NOT NULL AND v IS NOT NULL"))
    # What a rule says of any address of a component, whether or not its page is in the table.
    ends = links.select("url").union(links.select("target")).select(
        address_of(url).alias("node"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    ruled_ends = ends.distinct().join(matched_rules(ends, rules), ["host", "path"])
    said = joined.join(ruled_ends, "node").groupBy("component").agg(
        F.max(F.col("rule_verdict") == "allow").alias("allowed"),
        F.max(F.col("rule_verdict") == "block").alias("blocked"),
    )
    passed_on = F.when(F.col("blocked") & ~F.col("allowed"), "block").otherwise("allow")
    by_alias = joined.join(said, "component").select(
        F.col("node").alias("_address"), passed_on.alias("_alias_verdict")
    )
    new = ["host", "path", "rule", "verdict"]
    given = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c not in new])
    named = apart(given, "url", "html")
    placed = named.select(
        "*", host_of(url).alias("host"), path_of(url).alias("path"), address_of(url).alias("_address")
    )
    # No rule and no alias has an empty address; pages without one are spread by numbers that none has.
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(1024)) + 1
    placed = placed.withColumn("spread", F.when(F.col("host") == "", spread).otherwise(0))
    ruled = placed.join(
        matched_rules(placed, rules).withColumn("spread", F.lit(0).cast("bigint")),
        ["host", "path", "spread"], "left",
    )
    nowhere = F.when(F.col("_address").isNull(), spread).otherwise(0)
    decided = ruled.withColumn("spread", nowhere).join(
        by_alias.withColumn("spread", F.lit(0).cast("bigint")), ["_address", "spread"], "left"
    )
    verdict = F.coalesce("rule_verdict", "_alias_verdict", F.lit(default))
    columns = [*[f"`{c}`" for c in named.columns], "host", "path", "rule"]
    return together(decided.select(*columns, verdict.alias("verdict")), given)
