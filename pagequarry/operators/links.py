"""Links of pages: extraction, resolution and the same-site rule. No shuffle is needed for any of it."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.url import netloc, with_absolute_url, with_base_parts

# Fixed value: quoted, non-empty link targets of anchors that do not start with '#'.
LINK_PATTERN = r"""(?iU)<a\s+(?:[^>]*?\s+)?href=["']([^"' >#][^"' >]*)["']"""


def extract_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """One row per link: the page's other columns, ``pos`` (0-based, document order) and ``href``."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit(LINK_PATTERN), F.lit(1))
    kept = [c for c in pages.columns if c not in (html, url)]
    return pages.select(*kept, F.col(url).alias("url"), F.posexplode(hrefs).alias("pos", "href"))


def resolve_links(links: DataFrame) -> DataFrame:
    """Add ``abs_url``: the link against its page's URL, without fragment."""
    return with_absolute_url(links, "url", "href")


def same_site(links: DataFrame, site: str | Column | None = None) -> DataFrame:
    """Links whose network location equals ``site``; by default that of their own page."""
    wanted = netloc("url") if site is None else F.lit(site) if isinstance(site, str) else site
    return links.where(netloc("abs_url") == wanted)


def site_links(pages: DataFrame, site: str | Column | None = None) -> DataFrame:
    """Extract, resolve and keep the links of the site."""
    return same_site(resolve_links(extract_links(with_base_parts(pages, "url"))), site)
