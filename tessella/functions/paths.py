"""URL and path functions as Column expressions. Paths are text; nothing is looked up on a disk."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def reference_kind(raw: Column) -> Column:
    return (
        F.when(F.trim(F.coalesce(raw, F.lit(""))) == "", "empty")
        .when(raw.rlike(r"^(//|[A-Za-z][A-Za-z0-9+.\-]*:)"), "absolute")
        .when(raw.startswith("#"), "fragment")
        .when(raw.startswith("/"), "rooted")
        .otherwise("relative")
    )


def percent_decode(text: Column) -> Column:
    """Plus signs are plus signs here, unlike in form data; text that can't be decoded stays."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def percent_encode(path: Column) -> Column:
    out = F.url_encode(path)
    for a, b in (("+", "%20"), ("%2F", "/"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def split_reference(raw: Column) -> Column:
    """path (decoded, slashes forward), query, fragment."""
    before = F.split_part(raw, F.lit("#"), F.lit(1))
    fragment = F.when(F.instr(raw, "#") > 0, F.expr("null") if raw is None else F.substring_index(raw, "#", -1)).otherwise("")
    query = F.when(F.instr(before, "?") > 0, F.substring_index(before, "?", -1)).otherwise("")
    return F.struct(F.replace(percent_decode(F.split_part(before, F.lit("?"), F.lit(1))), F.lit("\\"), F.lit("/")).alias("path"), query.alias("query"), fragment.alias("fragment"))


def normal_path(path: Column) -> Column:
    """Single dots and inner parents resolved; parents that lead out stay."""
    parts = F.filter(F.split(path, "/"), lambda p: ~p.isin("", "."))
    folded = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, p: F.when((p == "..") & (F.size(acc) > 0) & (F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit("..")) != ".."), F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(p))),
    )
    return F.array_join(folded, "/")


def resolve(folder: Column, path: Column) -> Column:
    return normal_path(F.concat_ws("/", folder, path))


def escapes(path: Column) -> Column:
    return (path == "..") | path.startswith("../")


def parent(path: Column) -> Column:
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise("")


def leaf(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def relative_to(folder: Column, path: Column) -> Column:
    """The path from a folder to a file, both from the same root."""
    a, b = F.filter(F.split(folder, "/"), lambda p: p != ""), F.split(path, "/")
    same = F.aggregate(F.sequence(F.lit(1), F.greatest(F.least(F.size(a), F.size(b) - 1), F.lit(1))), F.lit(0), lambda n, i: F.when((n == i - 1) & (F.get(a, i - 1) == F.get(b, i - 1)), i).otherwise(n))
    return F.array_join(F.concat(F.array_repeat(F.lit(".."), F.size(a) - same), F.slice(b, same + 1, F.size(b))), "/")


def ancestors(path: Column) -> Column:
    """Every folder above a path, nearest the root first, the root's '' left out."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) < 2, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.array_join(F.slice(parts, 1, n), "/")))


def without_page_folders(path: Column) -> Column:
    """Folders that are named like pages taken out, the file itself kept."""
    parts = F.split(path, "/")
    return F.array_join(F.filter(parts, lambda p, i: (i == F.size(parts) - 1) | ~p.rlike(r"(?i)\.x?html?$")), "/")


def to_markdown(path: Column) -> Column:
    return F.regexp_replace(path, r"(?i)\.x?html?$", ".md")


def is_topic(path: Column) -> Column:
    return path.rlike(r"(?i)\.x?html?$")


def page_key(url: Column) -> Column:
    """The decoded path of a URL without its leading slash."""
    return F.regexp_replace(percent_decode(F.regexp_extract(url, r"^[a-z]+://[^/?#]*([^?#]*)", 1)), "^/+", "")


def package_folder(url: Column) -> Column:
    found = F.regexp_extract(url, r"/pub/(.+)/[^/]+$", 1)
    return F.when(found != "", found)


def origin_url(template: Column, path: Column, folder: Column) -> Column:
    return F.replace(F.replace(template, F.lit("{folder}"), folder), F.lit("{path}"), path)


def asset_path(unit: Column, country: Column, language: Column, name: Column) -> Column:
    return F.concat_ws("/", F.lit("/content/dam"), unit, country, language, name)


def rooted(path: Column) -> Column:
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))


def unrooted(path: Column) -> Column:
    return F.regexp_replace(path, "^/+", "")


def served_url(host: Column, path: Column) -> Column:
    """Markdown pages are served as HTML; a language folder such as en-us is served as us/en."""
    page = F.regexp_replace(path, r"\.md$", ".html")
    return F.concat(host, F.lit("/"), F.regexp_replace(page, r"^([a-z]{2})-([a-z]{2})/", "$2/$1/"))


def is_unsafe(member: Column) -> Column:
    """Archive members that must not be written: absolute, climbing, reserved characters, device names, odd endings."""
    parts = F.split(F.replace(member, F.lit("\\"), F.lit("/")), "/")
    bad = F.exists(parts, lambda p: (p == "..") | p.rlike(r'[:*?"<>|]') | p.rlike(r"[. ]$") | p.rlike(r"(?i)^(con|prn|aux|nul|com[1-9]|lpt[1-9])(\..*)?$"))
    return member.startswith("/") | bad


def unpublishable(path: Column, size: Column) -> Column:
    """Why a file can't be published, or ''."""
    return F.when(path.rlike(r"(?i)\.(exe|dll|msi|bat|sh)$"), "type").when(size >= 100 * 1024 * 1024, "size").otherwise("")
