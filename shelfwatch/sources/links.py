"""Links to price and store files in listing pages."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.functions.html import anchors, attribute, has_class

DELIVERY_PREFIXES = ("Price", "Store")


def page_links(
    pages: DataFrame,
    attr: str = "title",
    prefixes: tuple[str, ...] = DELIVERY_PREFIXES,
    css_class: str | None = "f",
) -> DataFrame:
    """One row per matching anchor: page, position of the anchor, attribute value."""
    tags = pages.select("page_id", F.posexplode(anchors(F.col("html"))).alias("position", "tag"))
    if css_class is not None:
        tags = tags.filter(has_class(F.col("tag"), css_class))
    links = tags.select("page_id", "position", attribute(F.col("tag"), attr).alias("link"))
    return links.filter(reduce(or_, [F.col("link").startswith(p) for p in prefixes]))
