"""URL and SURT expressions. Every function maps Columns to a Column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import UK_SECOND_LEVEL, UK_SUFFIXES

_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
_HOSTNAME = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"
_BARE_HOST = r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?(?:www[0-9]*\.)?([^/?#:]*)"
_PORT = r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?[^/?#:]*(:[0-9]+)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
_SAFE_FOR_ACCESS_LIST = r"^[\p{L}\p{N}_ \t\n#':/.\-=?&~%+@,;]*$"


def _blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def url_host(url: Column) -> Column:
    """Host of a URL; for ``dns:`` lookups the looked-up name."""
    return F.when(url.startswith("dns:"), F.substr(url, F.lit(5))).otherwise(
        _blank_to_null(F.lower(F.regexp_extract(url, _HOSTNAME, 1)))
    )


def url_netloc(url: Column) -> Column:
    """Authority including user info and port, case kept, '' when absent."""
    return F.regexp_extract(url, _AUTHORITY, 1)


def url_path(url: Column) -> Column:
    """Path without the parameters of its last segment."""
    return F.regexp_replace(F.regexp_extract(url, _PATH, 1), r";[^/]*$", "")


def url_netloc_nowww(url: Column) -> Column:
    return F.regexp_replace(url_netloc(url), r"^(www([0-9]+)?)\.", "")


def tld(host: Column) -> Column:
    return F.element_at(F.split(host, r"\."), -1)


def second_level(host: Column) -> Column:
    """The registry label under the TLD, only when more labels precede it."""
    labels = F.split(host, r"\.")
    label = F.try_element_at(labels, F.lit(-2))
    return F.when((F.size(labels) > 2) & label.isin(UK_SECOND_LEVEL), label)


def registered_domain(host: Column, registries: list[str] | None = None) -> Column:
    """Registrable domain by longest suffix: three labels under a registry
    such as ``co.uk``, else two. ``registries`` replaces the default rule."""
    suffixes = registries if registries is not None else [f"{s}.uk" for s in UK_SECOND_LEVEL]
    labels = F.split(host, r"\.")
    n = F.size(labels)
    last_two = F.concat_ws(".", F.slice(labels, -2, 2))
    return (
        F.when(n < 2, F.lit(""))
        .when(last_two.isin(suffixes), F.when(n >= 3, F.concat_ws(".", F.slice(labels, -3, 3))).otherwise(""))
        .otherwise(last_two)
    )


def suffix_rules(lines: DataFrame, value: str = "value") -> DataFrame:
    """(rule) of a public-suffix list: one rule a line up to the first space, ``//`` comments left out."""
    rule = F.lower(F.regexp_extract(F.btrim(value), r"^(\S+)", 1))
    return lines.select(rule.alias("rule")).filter((F.col("rule") != "") & ~F.col("rule").startswith("//")).distinct()


def with_registered_domain(hosts: DataFrame, rules: DataFrame, host: str = "host", out: str = "domain") -> DataFrame:
    """Adds the registrable domain by the longest matching rule of a suffix list.

    A rule matches the end of a host label by label; ``*.`` stands for one label, and
    ``!`` takes a name out of such a rule. Without a rule the last label is the
    suffix. Addresses, null, and hosts that are a suffix themselves get NULL. Each distinct host
    meets the rules by an equi-join on the forms of its ends.
    """
    distinct = hosts.select(F.col(host).alias("_host")).filter("_host IS NOT NULL").distinct().select("_host", F.split(F.lower(F.regexp_replace("_host", r"\.+$", "")), r"\.").alias("_labels"))

    def tail(n: Column) -> Column:
        return F.array_join(F.slice("_labels", F.size("_labels") - n + 1, n), ".")

    n = F.col("_n")
    ends = distinct.select("_host", "_labels", F.explode(F.sequence(F.lit(1), F.size("_labels"))).alias("_n"))
    forms = F.array(
        F.struct(tail(n).alias("rule"), n.alias("length"), F.lit(0).alias("taken_out")),
        F.struct(F.concat(F.lit("*."), tail(n - 1)).alias("rule"), n.alias("length"), F.lit(0).alias("taken_out")),
        F.struct(F.concat(F.lit("!"), tail(n)).alias("rule"), (n - 1).alias("length"), F.lit(1).alias("taken_out")))
    matched = ends.select("_host", F.explode(forms).alias("_f")).select("_host", "_f.*").join(rules.select("rule").distinct(), "rule")
    best = matched.groupBy("_host").agg(F.max(F.struct("taken_out", "length")).alias("_best"))
    size = F.coalesce(F.col("_best.length"), F.lit(1))
    found = distinct.join(best, "_host", "left").select(
        "_host", F.when((F.size("_labels") > size) & ~F.col("_host").rlike(r"^[0-9.]+$|:"), F.array_join(F.slice("_labels", F.size("_labels") - size, size + 1), ".")).alias(out))
    return hosts.join(found, hosts[host] == found["_host"], "left").drop("_host")


def uk_scope(url: Column) -> Column:
    """Which UK ending the authority has, or ``not_uk``."""
    netloc = url_netloc(url)
    scope = F.lit("not_uk")
    for suffix in reversed(UK_SUFFIXES):
        scope = F.when(netloc.endswith(suffix), F.lit(suffix)).otherwise(scope)
    return scope


def _reversed_labels(netloc: Column) -> Column:
    return F.array_join(F.reverse(F.split(netloc, r"\.")), ",")


def surt_authority(url: Column) -> Column:
    """Host-only SURT, e.g. ``http://(uk,co,example,``."""
    return F.concat(F.lit("http://("), _reversed_labels(url_netloc(url)), F.lit(","))


def surt_simple(url: Column, host_only: bool = False) -> Column:
    """Host-only SURT followed by the folder part of the path."""
    authority = surt_authority(url)
    if host_only:
        return authority
    folder = F.regexp_extract(url_path(url), r"^(.*/)[^/]*$", 1)
    folder = F.when(folder.rlike(r"^/*$"), folder).otherwise(F.rtrim(folder, F.lit("/")))
    return F.concat(authority, folder)


def surt_host_prefixes(url: Column) -> Column:
    """All host-only SURTs that are string prefixes of the URL's simple SURT:
    one per label depth. Turns a host prefix join into an equi-join."""
    labels = F.reverse(F.split(url_netloc(url), r"\."))
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.concat(F.lit("http://("), F.array_join(F.slice(labels, F.lit(1), n), ","), F.lit(",")),
    )


def _decoded(text: Column) -> Column:
    """Percent-escapes of ASCII characters undone until none is left; others in lower case.

    A pass undoes all of them at once; ``%25`` may set a new one free, so there are
    as many passes as ``25`` occurs, and one.
    """
    def once(t: Column) -> Column:
        kept = F.regexp_replace(t, "%(?![0-7][0-9A-Fa-f])", "%25")
        return F.url_decode(F.replace(kept, F.lit("+"), F.lit("%2B")))

    passes = 1 + ((F.length(text) - F.length(F.replace(text, F.lit("25"), F.lit("")))) / 2).cast("int")
    return F.aggregate(F.sequence(F.lit(1), passes), text, lambda t, _: once(t))


def _encoded(text: Column) -> Column:
    """Escapes for white space, controls, what is not ASCII, and percent signs that escape nothing."""
    signs = F.regexp_replace(F.replace(text, F.lit("#"), F.lit("%23")), "%(?!23|[89a-f][0-9a-f])", "%25")
    each = F.transform(
        F.regexp_extract_all(signs, F.lit("(?s)."), F.lit(0)),
        lambda c: F.when((c > " ") & (c < "\u007f"), c).otherwise(F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))))
    return F.lower(F.array_join(each, ""))


def _without_dots(path: Column) -> Column:
    """A path without empty, ``.`` and ``..`` segments; the last one may be empty."""
    segments = F.split(F.substr(path, F.lit(2)), "/")
    folders = F.filter(segments, lambda s, i: (i == F.size(segments) - 1) | ((s != "") & (s != ".")))
    kept = F.aggregate(
        folders, F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(s))))
    last = F.element_at(segments, -1)
    return F.concat(F.lit("/"), F.array_join(F.when(last == ".", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(kept), "/"))


# Session ids that do not belong to a key, in paths and in queries.
_PATH_SESSIONS = [(r"^(.*/)(?:\((?:[a-z]\([0-9a-z]{24}\))+\)|\([0-9a-z]{24}\))/([^?]+\.aspx.*)$", "$1$2"), (r"^(.*?);jsessionid=[0-9a-z]{32}(.*)$", "$1$2")]
_QUERY_SESSIONS = r"(^|&)(?:(?:jsessionid|phpsessid|sid)=[0-9a-z]{32}|aspsessionid[a-z]{8}=[a-z]{24}|cfid=[^&]+&cftoken=[^&]+)(?=&|$)"
_ODD_PATH = r"%|//|/\.|;jsessionid=|/\(|[^\x21-\x7e]"
_ODD_QUERY = r"%|sid=|sessionid|cfid=|[^\x21-\x7e]"


def surt_canonical(url: Column) -> Column:
    """Canonical index key, e.g. ``com,example)/path?a=1&b=2``.

    Lower-cases, drops scheme, user info, ``www``, default ports, fragment, session
    ids and the trailing slash, undoes escapes of ASCII characters, escapes what a
    URL may not hold, folds dot segments, and orders query arguments by name then
    value. ``dns:`` and other schemes without an authority pass through lower-cased.
    """
    text = F.lower(F.substring_index(F.trim(url), "#", 1))
    host = F.regexp_extract(text, _BARE_HOST, 1)
    port = F.regexp_extract(text, _PORT, 1)
    default_port = F.when(text.startswith("https:"), F.lit(":443")).otherwise(F.lit(":80"))
    port = F.when(port == default_port, F.lit("")).otherwise(port)
    path = F.regexp_extract(text, _AUTHORITY + r"([^?#]*)", 2)
    mended = _without_dots(F.lower(_decoded(path)))
    for pattern, rest in _PATH_SESSIONS:
        mended = F.regexp_replace(mended, pattern, rest)
    path = F.rtrim(F.when(path.rlike(_ODD_PATH), _encoded(mended)).otherwise(path), F.lit("/"))
    path = F.when(path == "", F.lit("/")).otherwise(path)
    asked = F.substr(text, F.locate("?", text) + 1)
    arguments = F.regexp_replace(F.regexp_replace(F.lower(_decoded(asked)), _QUERY_SESSIONS, ""), "^&", "")
    asked = F.when(asked.rlike(_ODD_QUERY), _encoded(arguments)).otherwise(asked)
    # The mark sorts below every character, so whole arguments sort by name first.
    marked = F.regexp_replace(asked, r"(^|&)([^=&]*)=", "$1$2\u0001")
    ordered = F.translate(F.array_join(F.sort_array(F.split(marked, "&")), "&"), "\u0001", "=")
    query = (
        F.when(~text.contains("?") | (asked == ""), F.lit(""))
        .when(asked.contains("&"), F.concat(F.lit("?"), ordered))
        .otherwise(F.concat(F.lit("?"), asked))
    )
    key = F.concat(_reversed_labels(host), port, F.lit(")"), path, query)
    return F.when(text.rlike(_AUTHORITY + "(?<=[^/])"), key).otherwise(text)


def surt_host_key(surt: Column) -> Column:
    """Everything before the bracket of a canonical SURT."""
    return F.substring_index(surt, ")", 1)


def acl_surt(url: Column) -> Column:
    """Access-list form ``http://(com,example,``; NULL for unsafe characters."""
    surt = surt_canonical(url)
    bracketed = (
        F.when(surt.rlike(r"^https?://"), surt)
        .when(surt.startswith("("), F.concat(F.lit("http://"), surt))
        .otherwise(F.concat(F.lit("http://("), surt))
    )
    return F.when(url.rlike(_SAFE_FOR_ACCESS_LIST), F.regexp_replace(bracketed, r"\)/$", ","))


def resolve_redirect(base: Column, location: Column) -> Column:
    """Absolute form of a Location header relative to the URL that sent it."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    no_fragment = F.regexp_replace(base, r"#.*$", "")
    no_query = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.regexp_extract(F.regexp_extract(base, _PATH, 1), r"^(.*/)[^/]*$", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    merged = F.when(location.startswith("/"), location).otherwise(F.concat(folder, location))
    path = F.regexp_extract(merged, r"^([^?#]*)", 1)
    tail = F.regexp_extract(merged, r"^[^?#]*(.*)$", 1)
    segments = F.split(F.regexp_replace(path, r"^/", ""), "/")
    kept = F.aggregate(
        F.filter(segments, lambda s: s != "."),
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(
            F.concat(acc, F.array(s))
        ),
    )
    ends_in_dots = path.rlike(r"(^|/)\.\.?$")
    clean = F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(ends_in_dots & (F.size(kept) > 0), F.lit("/")).otherwise(""))
    return (
        F.when(location == "", base)
        .when(location.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), location)
        .when(location.startswith("//"), F.concat(scheme, F.lit(":"), location))
        .when(location.startswith("#"), F.concat(no_fragment, location))
        .when(location.startswith("?"), F.concat(no_query, location))
        .otherwise(F.concat(root, clean, tail))
    )


def seed_variants(seed: Column) -> Column:
    """The seed, its fragment-free copy and its slash-ended copy, distinct."""
    return F.array_distinct(
        F.array_compact(
            F.array(
                seed,
                F.regexp_replace(seed, r"#.*$", ""),
                F.when(url_path(seed) == "", F.concat(seed, F.lit("/"))),
            )
        )
    )


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def document_filename(url: Column) -> Column:
    return basename(url_path(url))
