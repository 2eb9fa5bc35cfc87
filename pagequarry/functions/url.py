"""URL expressions after RFC 3986, written with built-ins only.

``parse_url`` raises on characters such as a space and its HOST part drops port and user info, so the
parts come from a pattern instead.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Scheme, network location, path and query of a URL reference.
URL_PATTERN = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"
SCHEME, NETLOC, PATH, QUERY = 1, 2, 3, 4
# Parameters hang off the last path segment after a semicolon.
PARAMS_PATTERN = r";([^/]*)\z"
INDEX_FILE = "index.html"
# Relative references resolve against these base schemes only.
WEB_SCHEMES = ("http", "https")


def _clean(url: Column) -> Column:
    return F.regexp_replace(url, r"^[\x00-\x20]+|[\t\r\n]", "")


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, URL_PATTERN, group)


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def netloc(url) -> Column:
    """Network location with user info and port, case kept."""
    return _part(_clean(_column(url)), NETLOC)


def url_path(url) -> Column:
    """Path without the ``;params`` of its last segment, query and fragment."""
    return F.regexp_replace(_part(_clean(_column(url)), PATH), PARAMS_PATTERN, "")


def page_rel_path(url) -> Column:
    """File path of a page: its URL path, with ``index.html`` for a directory. The query is ignored."""
    path = F.regexp_replace(url_path(url), "^/+", "")
    return F.when((path == "") | path.endswith("/"), F.concat(path, F.lit(INDEX_FILE))).otherwise(path)


def cut_fragment(url) -> Column:
    return F.split(_column(url), "#", 2)[0]


def _fold_dots(segments: Column) -> Column:
    """Apply ``.`` and ``..`` segments and join the rest; climbing above the root is ignored."""
    folded = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(s == ".", done)
        .otherwise(F.concat(done, F.array(s))),
    )
    ends_in_dots = F.element_at(segments, -1).isin(".", "..")
    return F.array_join(F.concat(folded, F.when(ends_in_dots, F.array(F.lit(""))).otherwise(F.array())), "/")


def _merge(folder: Column, link_path: Column) -> Column:
    """Segments of a relative path placed in a folder. Empty ones inside vanish; the first and the last stay."""
    link = F.split(link_path, "/")
    inner = F.concat(F.slice(folder, F.lit(2), F.size(folder)), F.slice(link, F.lit(1), F.size(link) - 1))
    return F.concat(F.slice(folder, 1, 1), F.array_remove(inner, ""), F.slice(link, -1, 1))


BASE_PARTS = ("_bs", "_bn", "_bp", "_bpp", "_bq", "_folder")


def with_base_parts(df: DataFrame, base: str) -> DataFrame:
    """Add the parts of a page URL that resolving needs. Done before links are exploded, it is done once per page."""
    b = _clean(F.col(base))
    raw = df.withColumns(
        {"_bs": F.lower(_part(b, SCHEME)), "_bn": _part(b, NETLOC), "_bq": _part(b, QUERY), "_bp": _part(b, PATH)}
    )
    split = raw.withColumns(
        {"_bpp": F.regexp_extract("_bp", PARAMS_PATTERN, 1), "_bp": F.regexp_replace("_bp", PARAMS_PATTERN, "")}
    )
    # the last segment is a file; an empty one keeps its place in front of what follows
    segments = F.split(F.regexp_replace("_bp", "[^/]+$", ""), "/")
    return split.withColumn(
        "_folder", F.when(F.size(segments) > 1, F.slice(segments, F.lit(1), F.size(segments) - 1)).otherwise(segments)
    )


def with_absolute_url(df: DataFrame, base: str, link: str, out: str = "abs_url") -> DataFrame:
    """Add ``out``: the link resolved against the page URL, cut at the first ``#``.

    The parts are separate columns on purpose: each is read several times, so Catalyst keeps them as
    projections of their own instead of repeating the patterns in every branch. The result passes through a
    one-element ``explode`` for the same reason: a filter on it is then applied to the finished URL, where a
    plain column would let the filter be pushed down with the whole expression written out again.
    """
    based = df if set(BASE_PARTS) <= set(df.columns) else with_base_parts(df, base)
    kept = [c for c in df.columns if c not in BASE_PARTS]
    r = _clean(F.col(link))
    raw = based.withColumns(
        {
            "_ls": F.lower(_part(r, SCHEME)),
            "_ln": _part(r, NETLOC),
            "_lp": _part(r, PATH),
            "_lq": _part(r, QUERY),
        }
    )
    split = raw.withColumns(
        {"_lpp": F.regexp_extract("_lp", PARAMS_PATTERN, 1), "_lp": F.regexp_replace("_lp", PARAMS_PATTERN, "")}
    )
    bs, bn, bp, bpp, bq, folder = (F.col(c) for c in BASE_PARTS)
    ls, ln, lp, lpp, lq = (F.col(c) for c in ("_ls", "_ln", "_lp", "_lpp", "_lq"))
    foreign = (base_missing := F.col(base) == "") | ~bs.isin(*WEB_SCHEMES) | ((ls != "") & (ls != bs))
    staged = split.withColumns(
        {
            # 'link': as it stands, 'host': its own path, 'page': the page's path, 'path': a path to place
            "_kind": F.when((F.col(link) == "") & ~base_missing, "page")
            .when(foreign, "link")
            .when(ln != "", "host")
            .when((lp == "") & (lpp == ""), "page")
            .otherwise("path"),
            "_segments": F.when(lp.startswith("/"), F.when(lp.rlike(r"/\.\.?(/|\z)"), F.split(lp, "/"))).otherwise(
                _merge(folder, lp)
            ),
        }
    )
    kind, segments = F.col("_kind"), F.col("_segments")
    placed = F.when(segments.isNull(), lp).otherwise(_fold_dots(segments))
    chosen = staged.withColumns(
        {
            "_host": F.when(kind == "host", ln).otherwise(bn),
            "_path": F.when(kind == "page", bp).when(kind == "path", placed).otherwise(lp),
            "_params": F.when(kind == "page", bpp).otherwise(lpp),
            "_query": F.when((kind == "page") & (lq == ""), bq).otherwise(lq),
        }
    )
    host, path, params, query = (F.col(c) for c in ("_host", "_path", "_params", "_query"))
    # a placed path that came out empty is the root; other empty paths stay empty
    slash = F.when(path == "", F.when(kind == "path", "/").otherwise("")).when(path.startswith("/"), "").otherwise("/")
    joined = F.concat(
        bs,
        F.lit("://"),
        host,
        slash,
        path,
        F.when(params != "", F.concat(F.lit(";"), params)).otherwise(""),
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
    )
    resolved = F.when(kind == "link", cut_fragment(link)).otherwise(joined)
    return chosen.select(*kept, F.explode(F.array(resolved)).alias(out))
