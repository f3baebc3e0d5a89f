"""URL filter with redirect equivalence, with DataFrame functions only.

A rule (host, path, allow) fits a URL if the host is the rule's or a subdomain of it and
the path starts with the rule's.  The longest rule wins (host and path together; then the
longer host; then allow).  URLs without a rule take the method's verdict:

1. Canonical links and meta refreshes in the pages' heads, and rows of a redirect log
   if given, are edges between URLs.  Links are resolved against the page or its base.
2. Connected components of the edges are groups of aliases.  Their members, link targets
   that are no page included, are judged by the rules.
3. A block rule on any member blocks the members without a rule of their own.  An allow
   rule takes precedence for the URL it fits and does not clear its aliases.  All others
   are allowed.

Up to ``IN_ROW`` rules are compared inside the row; more are joined by host suffix and path
head.  Aliases are told apart by host, path (empty: ``/``) and query: scheme and fragment
do not count.

Edge cases: a null URL, or one without ``://``, has empty host and path, fits no rule, has
no aliases and is allowed; null html has no links; repeated rows are judged alike, each
giving a row; links in comments, scripts and bodies, and to other schemes (``mailto:``),
are no edges; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veridq.llm.common import ascii_lower, materialise
from veridq.llm.components import components

IN_ROW = 256  # rules that are compared inside the row
SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)(\??[^#]*)"

RULE = "host string, path string, allow boolean"


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), SPLIT, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), SPLIT, 2)


def _key(host: Column, path: Column, query: Column) -> Column:
    """16 bytes that stand for the URL; null without a host."""
    full = F.concat(host, F.when(path == "", F.lit("/")).otherwise(path), F.when(query == "?", F.lit("")).otherwise(query))
    return F.when(host != "", F.unhex(F.substring(F.sha2(full.cast("binary"), 256), 1, 32)))


def key_of(url: Column) -> Column:
    return _key(host_of(url), path_of(url), F.regexp_extract(F.coalesce(url, F.lit("")), SPLIT, 3))


# ---- links -------------------------------------------------------------------

#: An attribute's value, with or without quotes; a reference to ``&`` is decoded.
VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def _attribute(tag: Column, name: str) -> Column:
    pattern = rf"(?is)[\s\"'/]{name}{VALUE}"
    value = F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])
    return F.trim(F.regexp_replace(value, "(?i)&amp;|&#38;|&#x26;", "&"))


def _undot(path: Column) -> Column:
    """A path without ``.`` and ``..`` segments."""
    parts = F.split(path, "/", -1)
    last = F.element_at(parts, -1)
    step = lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1)))).when(s == ".", acc).otherwise(F.concat(acc, F.array(s)))
    kept = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.array(F.lit("")), step)
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), F.concat(F.array_join(kept, "/"), F.when(last.isin(".", "..") , F.lit("/")).otherwise(F.lit("")))).otherwise(path)


def _resolve(host: Column, path: Column, query: Column, ref: Column) -> Column:
    """Absolute URL of the reference ``ref`` on a page; null for other schemes."""
    root = F.concat(F.lit("http://"), host)
    pathless = F.regexp_extract(ref, r"(?s)^[^?#]*", 0)
    rest = F.substring(ref, F.length(pathless) + 1, F.length(ref))
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, r"(?s)^.*/", 0))
    return (
        F.when(ref.rlike(r"(?i)^https?://"), ref)
        .when(ref.startswith("//"), F.concat(F.lit("http:"), ref))
        .when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.lit(None))
        .when((ref == "") | ref.startswith("#"), F.concat(root, path, query))
        .when(ref.startswith("?"), F.concat(root, path, ref))
        .when(ref.startswith("/"), F.concat(root, _undot(pathless), rest))
        .otherwise(F.concat(root, _undot(F.concat(folder, pathless)), rest))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """from_url, to_url of the canonical links and refreshes in the heads of ``pages``."""
    some = pages.select("url", "html").where(F.col("html").rlike("(?i)canonical|http-equiv") & (host_of(F.col("url")) != ""))
    bare = F.regexp_replace("html", r"(?is)<!--.*?(?:-->|$)|<(script|style)\b.*?</\1", " ")
    head = F.regexp_replace(bare, r"(?is)<body\b.*", "")
    tags = some.select("url", F.regexp_extract_all(head, F.lit(r"(?is)<(?:link|meta|base)\b[^>]*+>"), F.lit(0)).alias("tags"))
    is_ = lambda t, kind: t.rlike(rf"(?i)^<{kind}")
    named = lambda t, name, word: F.array_contains(F.split(F.lower(_attribute(t, name)), r"\s+"), word)
    refs = F.concat(
        F.transform(F.filter("tags", lambda t: is_(t, "link") & named(t, "rel", "canonical")), lambda t: _attribute(t, "href")),
        F.transform(
            F.filter("tags", lambda t: is_(t, "meta") & named(t, "http-equiv", "refresh")),
            lambda t: F.regexp_extract(_attribute(t, "content"), r"""(?is)^[\d.\s]*[;,]?\s*url\s*=\s*["']?([^"']*)""", 1),
        ),
    )
    base = F.transform(F.filter("tags", lambda t: is_(t, "base") & (_attribute(t, "href") != "")), lambda t: _attribute(t, "href"))
    found = tags.select("url", F.get(base, F.lit(0)).alias("base"), refs.alias("refs")).where(F.size("refs") > 0)
    parts = lambda u: (host_of(u), path_of(u), F.regexp_extract(u, SPLIT, 3))
    found = found.withColumn("at", F.coalesce(_resolve(*parts(F.col("url")), F.col("base")), "url"))
    each = found.select("url", "at", F.explode("refs").alias("ref")).where("ref <> ''")
    return each.select(F.col("url").alias("from_url"), _resolve(*parts(F.col("at")), F.col("ref")).alias("to_url")).where("to_url is not null")


# ---- rules -------------------------------------------------------------------


def _order(host: Column, path: Column, allow: Column) -> Column:
    return F.struct((F.length(host) + F.length(path)).alias("n"), F.length(host).alias("h"), allow.alias("allow"), F.concat(host, path).alias("rule"))


def _in_row(urls: DataFrame, rules: list) -> DataFrame:
    each = [F.struct(F.lit(r.host).alias("host"), F.lit(r.path).alias("path"), F.lit(r.allow).alias("allow")) for r in rules]
    if not each:
        return urls.select("*", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("boolean").alias("allow"))
    fits = lambda r: ((F.col("host") == r.host) | F.endswith(F.col("host"), F.concat(F.lit("."), r.host))) & F.startswith(F.col("path"), r.path)
    best = F.array_max(F.transform(F.filter(F.array(*each), fits), lambda r: _order(r.host, r.path, r.allow)))
    return urls.withColumn("best", best).select(*urls.columns, "best.rule", "best.allow")


def _joined(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """By equi-joins: each distinct (host, path) meets the rules of its host's suffixes at
    the lengths of path that those rules have."""
    labels = rules.agg(F.max(F.size(F.split("host", r"\."))).alias("m")).first().m or 0
    lengths = rules.groupBy("host").agg(F.collect_set(F.length("path")).alias("lengths")).withColumnRenamed("host", "suffix")
    distinct = urls.select("host", "path").where("host <> ''").distinct()
    suffixes = f"transform(sequence(1, least(size(l), {labels})), i -> array_join(slice(l, -i, i), '.'))"
    tails = distinct.withColumn("l", F.split("host", r"\.")).select("host", "path", F.explode(F.expr(suffixes)).alias("suffix"))
    heads = tails.join(lengths, "suffix").select("host", "path", "suffix", F.explode("lengths").alias("len")).where("len <= length(path)")
    heads = heads.withColumn("head", F.expr("substring(path, 1, len)"))
    named = rules.select(F.col("host").alias("suffix"), F.col("path").alias("head"), "allow")
    best = heads.join(named, ["suffix", "head"]).groupBy("host", "path").agg(F.max(_order(F.col("suffix"), F.col("head"), F.col("allow"))).alias("best"))
    return urls.join(best, ["host", "path"], "left").select(*urls.columns, "best.rule", "best.allow")


def by_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls(host, path, ...)`` with ``rule`` and ``allow`` of the rule that wins (else null)."""
    rules = rules.select(ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "allow").where("host <> '' and allow is not null")
    few = rules.limit(IN_ROW + 1).collect()
    return _in_row(urls, few) if len(few) <= IN_ROW else _joined(urls, rules)


# ---- verdicts ----------------------------------------------------------------


def blocked_aliases(links: DataFrame, rules: DataFrame) -> DataFrame:
    """``key`` of every URL in a component of ``links(from_url, to_url)`` that has a member
    with a block rule."""
    ends = lambda c: links.select(key_of(F.col(c)).alias("key"), host_of(F.col(c)).alias("host"), path_of(F.col(c)).alias("path"))
    label = components(links.select(key_of(F.col("from_url")).alias("a"), key_of(F.col("to_url")).alias("b")), "url-aliases")
    bad = by_rules(ends("from_url").unionByName(ends("to_url")), rules).where("not allow").select(F.col("key").alias("node")).distinct()
    groups = label.join(bad, "node", "left_semi").select("label").distinct()
    return label.join(groups, "label", "left_semi").select(F.col("node").alias("key"))


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages(page_id, url, html)``.

    ``rules(host, path, allow)``; ``redirects(from_url, to_url)``: a redirect log."""
    links = page_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("from_url", "to_url"))
    links = materialise(links, "url-links")
    url = F.col("url")
    rows = by_rules(pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), key_of(url).alias("key")), rules)
    of_rule = F.when(F.col("allow"), F.lit("allow")).when(~F.col("allow"), F.lit("block"))
    if links.isEmpty():
        return rows.select("page_id", "host", "path", "rule", F.coalesce(of_rule, F.lit("allow")).alias("verdict"))
    bad = blocked_aliases(links, rules).withColumn("bad", F.lit(True))
    got = rows.join(bad, "key", "left")
    alias = F.when(F.col("bad"), F.lit("block")).otherwise(F.lit("allow"))
    return got.select("page_id", "host", "path", "rule", F.coalesce(of_rule, alias).alias("verdict"))
