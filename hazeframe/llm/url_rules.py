"""URL block and allow rules, carried over redirects and canonical links to the aliases of a page.

Built from DataFrame functions only. A page's own rule decides first; pages without a rule take the verdict of the
pages that they redirect to, or name as canonical, or that do so to them, directly or over others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe.llm.common import ascii_lower, spread, table
from hazeframe.llm.components import components

#: (rule, verdict); a rule is a host, which stands for its subdomains as well, and a path that begins with "/".
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
#: Host labels that name a variant of a site rather than another site.
VARIANTS = "^(?:www|m|amp|mobile)[.](?=.*[.])"
#: Query fields that identify a visit rather than a page.
VISIT = "(?:^|&)(?:utm_[a-z]+|gclid|fbclid|ref)=[^&]*"
#: Where a page names another address of itself, every time that it does. Attributes may stand in either order, in any quotes.
LINKS = (
    r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)""",
    r"""(?is)<meta\b(?=[^>]*\bproperty\s*=\s*["']?og:url\b)[^>]*\bcontent\s*=\s*["']?([^"'\s>]+)""",
    r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["']?[\s\d.;,]*url\s*=\s*["']?([^"'\s>]+)""",
)
#: The address from which a page's own links start, if it names one: the first counts.
BASE = r"""(?is)<base\b[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
#: How "&" is written within an attribute.
AMPERSAND = "(?i)&(?:amp|#38|#x26);"


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; empty without "://"."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to "?", "#" or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def page_key(url: Column) -> Column:
    """One text for the spellings of an address: without scheme, variant label, visit fields, fragment, final "/"."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*[?]([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, VISIT, ""), "^&", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), "/(?:index[.](?:html?|php))?$", ""), "[.]html?$", "")
    site = F.regexp_replace(host_of(url), VARIANTS, "")
    return F.concat(site, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def plain_link(written: Column) -> Column:
    """An address as it is written in an attribute, with its ampersands plain."""
    return F.regexp_replace(written, AMPERSAND, "&")


def absolute(link: Column, url: Column) -> Column:
    """`link` as it stands on the page at `url`; null if it isn't an address of the web."""
    scheme = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)
    origin = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*(?:/[^?#/]*)*/)", 1)
    folder = F.when(folder == "", F.concat(origin, F.lit("/"))).otherwise(folder)
    return (
        F.when(link.rlike("(?i)^https?://"), link)
        .when(link.rlike("^//"), F.concat(scheme, F.lit(":"), link))
        .when(link.rlike("(?i)^[a-z][a-z0-9+.-]*:"), F.lit(None))
        .when(link.startswith("/"), F.concat(origin, link))
        .when(link != "", F.concat(folder, link))
    )


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits as struct(rule, verdict), or null. Of equally long ones, allow wins."""
    longest_first = sorted(rules, key=lambda r: (-len(r[0]), r[1] != "allow", r[0]))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in reversed(longest_first):
        site, slash, rest = rule.partition("/")
        fits = (F.concat(F.lit("."), host).endswith(f".{site}") if site else F.lit(True)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def url_verdicts(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    *,
    default: str = "allow",
) -> DataFrame:
    """page_id, host, path, rule, verdict, alias_of for each row of `pages`.

    The verdict is that of the longest fitting rule. Without one, it comes from the connected component of the page's
    address over redirects and canonical links, all that it names: allow if an address there has an allow rule, else block if one has a
    block rule, else `default`. alias_of is the smallest address of that component. Null or odd urls have empty host and path,
    no rule, no aliases and the default; null html has no links; repeated rows are judged alike.
    """
    given = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))
    judged = given.select(
        "page_id", "html", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        F.when(host_of(F.col("url")) != "", page_key(F.col("url"))).alias("key"),
    ).withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    # The links as they are written, then as seen from the page or from the base that it names. Step by step, as each is
    # used several times by the next.
    written = F.flatten(F.array(*(F.regexp_extract_all("html", F.lit(pattern), 1) for pattern in LINKS)))
    linked = judged.where("key IS NOT NULL AND html IS NOT NULL").select("key", "url", "html", written.alias("written")).where(F.size("written") > 0)
    based = linked.select("key", "url", plain_link(F.regexp_extract("html", BASE, 1)).alias("named"), "written")
    based = based.select("key", F.coalesce(absolute(F.col("named"), F.col("url")), F.col("url")).alias("base"), "written")
    named = F.transform("written", lambda link: absolute(plain_link(link), F.col("base")))
    edges = based.select("key", F.explode(F.filter(named, F.isnotnull)).alias("link"))
    edges = edges.where(host_of(F.col("link")) != "").select(
        "key", page_key(F.col("link")).alias("other"), best_rule(host_of(F.col("link")), path_of(F.col("link")), rules).alias("best")
    )
    groups = components(edges, "key", "other")
    # One row for each address with a rule, then for each component, before anything meets the pages again. Addresses
    # that are only linked to count as well.
    known = judged.where("key IS NOT NULL").select("key", "best").unionByName(edges.select(F.col("other").alias("key"), "best"))
    known = known.where("best IS NOT NULL").groupBy("key").agg(F.min("best.verdict").alias("verdict"))
    decided = known.join(groups, known["key"] == groups["node"], "left")
    decided = decided.groupBy(F.coalesce("component", "key").alias("component")).agg(F.min("verdict").alias("carried"))
    aliases = groups.select(F.col("node").alias("key"), "component")
    plain = judged.select("page_id", "host", "path", "key", "best").join(aliases, "key", "left")
    plain = plain.withColumn("component", F.coalesce("component", "key"))
    return plain.join(spread(decided), "component", "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", "carried", F.lit(default)).alias("verdict"),
        F.col("component").alias("alias_of"),
    )


def op7(spark: SparkSession, folder: str) -> DataFrame:
    return url_verdicts(table(spark, folder, "pages"))


def _oracle() -> str:
    rules = ", ".join(f"('{r}', '{v}')" for r, v in RULES)

    def key(host: str, path: str, query: str) -> str:
        plain = f"regexp_replace(regexp_replace({query}, '(?:^|&)(?:utm_[a-z]+|gclid|fbclid|ref)=[^&]*', '', 'g'), '^&', '')"
        return f"""(CASE WHEN regexp_matches({host}, '^(www|m|amp|mobile)[.].*[.]') THEN regexp_replace({host}, '^(www|m|amp|mobile)[.]', '') ELSE {host} END)
      || regexp_replace(regexp_replace({path}, '/(index[.](html?|php))?$', ''), '[.]html?$', '')
      || CASE WHEN {plain} <> '' THEN '?' || {plain} ELSE '' END"""

    def absolute(link: str, url: str) -> str:
        link = f"regexp_replace({link}, '&(amp|#38|#x26);', '&', 'gi')"
        folder = f"regexp_extract({url}, '^(.*?://[^/?#]*(?:/[^?#/]*)*/)', 1, 's')"
        origin = f"regexp_extract({url}, '^(.*?://[^/?#]*)', 1, 's')"
        return f"""CASE WHEN regexp_matches({link}, '(?i)^https?://') THEN {link}
      WHEN starts_with({link}, '//') THEN regexp_extract({url}, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1) || ':' || {link}
      WHEN regexp_matches({link}, '(?i)^[a-z][a-z0-9+.-]*:') THEN NULL WHEN starts_with({link}, '/') THEN {origin} || {link}
      WHEN {link} <> '' THEN CASE WHEN {folder} = '' THEN {origin} || '/' ELSE {folder} END || {link} END"""

    return rf"""
WITH RECURSIVE rules(rule, verdict) AS (VALUES {rules}),
given AS (
  SELECT page_id, html, url,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path,
    regexp_extract(coalesce(url, ''), '^.*?://[^?#]*[?]([^#]*)', 1, 's') AS query
  FROM pages),
keyed AS (
  SELECT page_id, host, path,
    CASE WHEN host <> '' THEN {key('host', 'path', 'query')} END AS key
  FROM given),
judged AS (
  SELECT k.*, (SELECT max_by({{'rule': r.rule, 'verdict': r.verdict}}, length(r.rule)) FROM rules r
    WHERE ends_with('.' || k.host, '.' || split_part(r.rule, '/', 1)) AND starts_with(k.path, substr(r.rule, instr(r.rule, '/')))) AS best
  FROM keyed k),
tags AS (SELECT page_id, url, tag, kind FROM given, unnest(['<link', '<meta', '<meta']) WITH ORDINALITY AS k(head, kind),
  unnest(regexp_extract_all(html, '(?is)' || head || '\b[^>]*')) AS t(tag) WHERE html IS NOT NULL AND host <> ''),
written AS (
  SELECT page_id, url, CASE kind
    WHEN 1 THEN CASE WHEN regexp_matches(tag, '(?is)\brel\s*=\s*["'']?canonical\b') THEN regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) END
    WHEN 2 THEN CASE WHEN regexp_matches(tag, '(?is)\bproperty\s*=\s*["'']?og:url\b') THEN regexp_extract(tag, '(?is)\bcontent\s*=\s*["'']?([^"''\s>]+)', 1) END
    ELSE CASE WHEN regexp_matches(tag, '(?is)\bhttp-equiv\s*=\s*["'']?refresh\b')
      THEN regexp_extract(tag, '(?is)\bcontent\s*=\s*["'']?[\s\d.;,]*url\s*=\s*["'']?([^"''\s>]+)', 1) END END AS link,
    (SELECT regexp_extract(g.html, '(?is)<base\b[^>]*\bhref\s*=\s*["'']?([^"''\s>]+)', 1) FROM given g WHERE g.page_id = tags.page_id LIMIT 1) AS base
  FROM tags),
based AS (SELECT page_id, coalesce({absolute('base', 'url')}, url) AS url, link FROM written WHERE link <> ''),
links AS (SELECT page_id, {absolute('link', 'url')} AS url FROM based),
ends AS (
  SELECT page_id, translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path, regexp_extract(url, '^.*?://[^?#]*[?]([^#]*)', 1, 's') AS query
  FROM links WHERE url IS NOT NULL),
edges AS (
  SELECT j.key, e.host, e.path, {key('e.host', 'e.path', 'e.query')} AS other FROM ends e JOIN judged j USING (page_id) WHERE e.host <> ''),
both_ways AS (SELECT key AS a, other AS b FROM edges UNION SELECT other, key FROM edges),
reach AS (
  SELECT a AS node, a AS seen FROM both_ways UNION
  SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON reach.seen = both_ways.a),
components AS (SELECT node, min(seen) AS component FROM reach GROUP BY node),
ruled AS (
  SELECT key, best.verdict AS verdict FROM judged WHERE best IS NOT NULL AND key IS NOT NULL UNION ALL
  SELECT e.other, (SELECT max_by(r.verdict, length(r.rule)) FROM rules r
    WHERE ends_with('.' || e.host, '.' || split_part(r.rule, '/', 1)) AND starts_with(e.path, substr(r.rule, instr(r.rule, '/')))) FROM edges e),
carried AS (
  SELECT coalesce(c.component, r.key) AS component, min(r.verdict) AS verdict FROM ruled r LEFT JOIN components c ON c.node = r.key
  WHERE r.verdict IS NOT NULL GROUP BY 1)
SELECT j.page_id, j.host, j.path, j.best.rule AS rule, coalesce(j.best.verdict, c.verdict, 'allow') AS verdict, coalesce(k.component, j.key) AS alias_of
FROM judged j LEFT JOIN components k ON k.node = j.key LEFT JOIN carried c ON c.component = coalesce(k.component, j.key)
"""


#: Components are found by following links from every address to all it reaches, which suits small tables only.
ORACLE = _oracle()
