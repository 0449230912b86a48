"""URL filters with redirect equivalence.

A url's own verdict comes from the longest rule that fits it. Redirects (meta refresh) and
canonical links make urls aliases of each other; connected components over these edges carry a
block decision from any url of a component to every alias that no rule allows explicitly.
DataFrame functions only.

Defined results: a null url, or one without ``://``, has empty host and path, no rule and no
aliases, and is allowed; null html has no links; repeated rows get equal results; a link to a url
that is no row of the table still joins its component, and rules apply to it. Aliases are compared
by host, path and query; scheme and fragment do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from llm.common import connected, lower_ascii, saved, table

Rule = tuple[str, str, str]  # host, path, allow or block
RULES: tuple[Rule, ...] = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
                           ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def with_parts(df: DataFrame, url: str) -> DataFrame:
    """Add host, path and node (host, path and query: what identifies a resource)."""
    rest = F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return df.withColumns({
        "host": lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)),
        "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    }).withColumn("node", F.concat("host", "path", F.regexp_extract(rest, r"^[^?#]*(\?[^#]*)?", 1)))


def with_rule(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add rule (as written: host and path) and own (its action) of the longest fitting rule.

    Rules are a policy list of the caller's, tried longest first in one expression, so no row is
    shuffled to meet them.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r))
    rule, own = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, action in reversed(ordered):
        fits = (((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path))
        rule, own = F.when(fits, host + path).otherwise(rule), F.when(fits, action).otherwise(own)
    return df.withColumns({"rule": rule, "own": own})


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges (node, target url) from canonical links and meta refreshes, html comments left out."""
    plain = F.regexp_replace(F.col(html), r"(?s)<!--.*?-->", "")
    tags = F.expr(r"filter(regexp_extract_all(plain, '(?i)<(?:link|meta)\\b[^>]*>', 0), t -> "
                  r"t rlike '(?i)\\brel\\s*=\\s*[\"\']?[^\"\'>]*\\bcanonical\\b' "
                  r"or t rlike '(?i)\\bhttp-equiv\\s*=\\s*[\"\']?refresh\\b')")
    href = F.regexp_extract("tag", r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)""", 1)
    moved = F.regexp_extract("tag", r"""(?i)\bcontent\s*=\s*["']?[^"'>]*?\burl\s*=\s*['"]?([^"'\s>]+)""", 1)
    found = (with_parts(pages.where(F.col(html).rlike(r"(?i)\bcanonical\b|\brefresh\b")), url)
             .where(F.col("host") != "").withColumn("plain", plain)
             .select("host", "path", "node", F.explode(tags).alias("tag"))
             .withColumn("to", F.regexp_replace(F.when(href != "", href).otherwise(moved), "&amp;", "&"))
             .where(F.col("to") != ""))
    folder = F.regexp_extract(F.when(F.col("path") == "", "/").otherwise(F.col("path")), r"^.*/", 0)
    target = (F.when(F.col("to").contains("://"), F.col("to"))
              .when(F.col("to").startswith("//"), F.concat(F.lit("x:"), "to"))
              .when(F.col("to").startswith("/"), F.concat(F.lit("x://"), "host", "to"))
              .when(F.col("to").rlike("^[?#]"), F.concat(F.lit("x://"), "host", "path", "to"))
              .otherwise(F.concat(F.lit("x://"), "host", folder, "to")))
    return found.select("node", target.alias("target"))


def alias_blocks(edges: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Nodes whose component holds a blocked url; one row each."""
    ends = saved(with_parts(edges.withColumnRenamed("node", "source"), "target")
                 .where(F.col("host") != "").select("source", F.col("node").alias("goal")).distinct(), "op8-edges")
    roots = saved(connected(ends, "source", "goal"), "op8-roots")
    # a node is host, path and query written together, so its parts can be read from it again
    own = with_rule(with_parts(roots.withColumn("u", F.concat(F.lit("x://"), "node"))
                               .withColumnRenamed("node", "name"), "u"), rules)
    blocked = own.where(F.col("own") == "block").select("root").distinct()
    return roots.join(blocked, "root", "left_semi").select("node")


def filter_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    An own rule decides; else a url is blocked if any alias of it is blocked by a rule, and allowed
    otherwise. A url that a rule allows stays allowed whatever its aliases are.
    """
    marked = alias_blocks(link_edges(pages, url, html), rules).withColumn("aliased", F.lit(True))
    names = [c for c in pages.columns if c not in ("host", "path", "node", "rule", "own", "aliased", "verdict", html)]
    rows = with_rule(with_parts(pages.select(*[F.col(f"`{c}`") for c in names]), url), rules)
    verdict = F.coalesce("own", F.when(F.col("aliased"), "block"), F.lit("allow"))
    return rows.join(marked, "node", "left").withColumn("verdict", verdict).drop("node", "own", "aliased")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _case(values: dict[Rule, str]) -> str:
    ordered = sorted(values, key=lambda r: -len(r[0] + r[1]))
    return "case " + " ".join(f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') "
                              f"then '{values[h, p, a]}'" for h, p, a in ordered) + " end"


#: The tables of documents hold no canonical links or refreshes; aliases are tested in tests/llm.
ORACLE = f"""
with parts as (
  select page_id, coalesce(regexp_extract(url, '(?s)^.*?://(.*)$', 1), '') as rest from pages),
p as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from parts)
select page_id, host, path, {_case({r: r[0] + r[1] for r in RULES})} as rule,
       coalesce({_case({r: r[2] for r in RULES})}, 'allow') as verdict from p
"""
