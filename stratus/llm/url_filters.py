"""Block and allow rules on URLs, carried to the addresses that lead to the same page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.llm.columns import bind
from stratus.llm.components import connected_components
from stratus.llm.tables import store

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
Rules = dict[str, str]

#: Links in a page's head that name another address of it.
CANONICAL = r"(?i)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH = r"(?i)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*\burl\s*=\s*[\"']?([^\"'\s>]+)"
BASE = r"(?i)<base\b[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)"
#: Signs of an address that pages write as entities; the ampersand is the last to be put back.
ENTITIES = {
    "/": r"&(?:sol|#0*47|#[xX]0*2[fF]);", ":": r"&(?:colon|#0*58|#[xX]0*3[aA]);", "?": r"&(?:quest|#0*63|#[xX]0*3[fF]);",
    "=": r"&(?:equals|#0*61|#[xX]0*3[dD]);", "#": r"&(?:num|#0*35|#[xX]0*23);", "&": r"&(?:amp|AMP|#0*38|#[xX]0*26);",
}
#: Query parameters that say where a visitor came from, not which page is meant.
TRACKING = r"(?i)^(?:utm_[^=]*|gclid|dclid|fbclid|msclkid|yclid|igshid|mc_cid|mc_eid)(?:=|$)"
SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:"


def without_dots(path: Column) -> Column:
    """A path from ``/`` on without its ``.`` and ``..`` segments."""
    def step(kept: Column, part: Column) -> Column:
        up = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1)))
        return F.when(part == ".", kept).when(part == "..", up).otherwise(F.concat(kept, F.array(part)))

    parts = F.split(F.concat(path, F.when(path.rlike(r"/\.\.?$"), "/").otherwise("")), "/")
    kept = F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), F.array(F.lit("")), step, lambda kept: F.concat_ws("/", kept))
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), kept).otherwise(path)


def resolve(target: Column, base: Column) -> Column:
    """The address that ``target``, as a page at ``base`` writes it, stands for; null if it is none with a host."""
    for sign, written in ENTITIES.items():
        target = F.regexp_replace(target, written, sign)

    def resolved(x: Column) -> Column:
        to, base = x["target"], x["base"]
        scheme = F.regexp_extract(base, SCHEME, 0)
        site = F.regexp_extract(base, f"{SCHEME}//[^/?#]+", 0)
        here = F.regexp_extract(F.substr(base, F.length(site) + 1), r"(?s)^[^?#]*", 0)
        query = F.regexp_extract(F.substr(base, F.length(site) + 1), r"(?s)^[^#]*", 0)
        folder = F.coalesce(F.nullif(F.regexp_extract(here, "(?s)^.*/", 0), F.lit("")), F.lit("/"))
        path = F.regexp_extract(to, r"(?s)^[^?#]*", 0)
        rest = F.substr(to, F.length(path) + 1)
        full = F.when(to.rlike(SCHEME), to).when(to.startswith("//"), F.concat(scheme, to)).when(
            site == "", F.lit(None).cast("string")
        ).when((to == "") | to.startswith("#"), F.concat(site, query, to)).when(
            to.startswith("?"), F.concat(site, here, to)
        ).otherwise(F.concat(site, without_dots(F.when(to.startswith("/"), path).otherwise(F.concat(folder, path))), rest))
        return F.when(full.rlike(f"{SCHEME}//[^/?#]"), full)

    return bind(F.struct(target.alias("target"), base.alias("base")), resolved)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url or one without ``://``."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"(?s)^[^?#]*", 0)
    return F.translate(host, UPPER, UPPER.lower()), path


def best_rule(host: Column, path: Column, rules: Rules) -> Column:
    """The longest fitting rule, ``host/path-prefix``; null without one. Equal lengths: the first in order.

    The rules are a list given by the caller and become one constant expression, longest first.
    """
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, slash, prefix = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + prefix)
        found = F.when(fits, rule).otherwise(found)
    return found


def page_address(url: Column) -> Column:
    """The address without what does not change the page: scheme, ``www.``, fragment, final slash and tracking parameters.

    Null where there is no host. Servers redirect between these forms, so they count as aliases of this one. All other
    parameters stay as they are: they may name another page. ``://`` is escaped, so no address is taken for a url.
    """
    host, path = host_and_path(url)
    path = F.regexp_replace(path, "/+$", "")
    parameters = F.split(F.regexp_extract(url, r"(?s)^(?>.*?://)[^?#]*\?([^#]*)", 1), "&")
    query = F.concat_ws("&", F.filter(parameters, lambda x: (x != "") & ~x.rlike(TRACKING)))
    whole = F.concat(F.regexp_replace(host, r"^www\.", ""), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(host != "", F.replace(whole, F.lit("://"), F.lit(":%2F%2F")))


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges ``a, b`` between urls, and between a url and its page address, as far as the pages state them.

    Stated targets are resolved against the page's url, or its ``base`` if it names one.
    """
    rows = pages.select(F.col(url).alias("a"), F.col(html).alias("html")).filter("a IS NOT NULL")
    named = F.concat(F.regexp_extract_all("html", F.lit(CANONICAL), 1), F.regexp_extract_all("html", F.lit(REFRESH), 1))
    base = F.nullif(F.regexp_extract("html", BASE, 1), F.lit(""))
    targets = rows.select("a", base.alias("base"), F.explode(named).alias("target"))
    base = F.coalesce(resolve(F.col("base"), F.col("a")), F.col("a"))
    stated = targets.select("a", "target", base.alias("base")).select("a", resolve(F.col("target"), F.col("base")).alias("b"))
    return stated.unionByName(rows.select("a", page_address(F.col("a")).alias("b"))).unionByName(
        stated.select(F.col("b").alias("a"), page_address(F.col("b")).alias("b"))
    ).filter("a IS NOT NULL AND b IS NOT NULL")


def judge_urls(
    pages: DataFrame, rules: Rules, redirects: DataFrame | None = None,
    page_id: str = "page_id", url: str = "url", html: str = "html",
) -> DataFrame:
    """Per input row ``page_id, host, path, rule, verdict, component``.

    ``rules`` maps ``host/path-prefix`` to ``block`` or ``allow``; they fit subdomains too, the longest wins. A url that
    no rule fits takes the verdict of its aliases: the urls connected with it by canonical links and refresh redirects
    in the pages, by ``redirects`` (columns ``a, b``), or by having the same page address. If a rule allows any alias it
    is allowed; else, if one is blocked, it is blocked; else allowed. Targets that are no page of the table take part.
    A null or hostless url has no aliases, an empty host and path, and is allowed; repeated urls share one verdict.
    """
    edges = links(pages, url, html)
    if redirects is not None:
        edges = edges.unionByName(redirects.select("a", "b"))
    edges = store(edges.distinct(), "url-links")
    found = store(connected_components(edges), "url-components")
    host, path = host_and_path(F.col("node"))
    # Page addresses carry no scheme; they stand for urls and are judged through them.
    judged = found.select("component", best_rule(host, path, rules).alias("rule")).filter("rule IS NOT NULL")
    kinds = _kind(rules)
    named = judged.groupBy("component").agg(
        F.max(kinds == "allow").alias("allowed"), F.max(kinds == "block").alias("blocked")
    )
    verdicts = store(named.select("component", F.when(F.col("allowed"), "allow").otherwise("block").alias("inherited")), "url-verdicts")
    by_url = store(found.join(verdicts, "component", "left"), "url-aliases").withColumnRenamed("node", "url")
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")).join(by_url, "url", "left")
    rows = rows.select("page_id", host.alias("host"), path.alias("path"), "component", "inherited")
    rows = rows.withColumn("rule", best_rule(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(_kind(rules), F.col("inherited"), F.lit("allow"))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "component")


def _kind(rules: Rules) -> Column:
    kind = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        kind = F.when(F.col("rule") == rule, verdict).otherwise(kind)
    return kind
