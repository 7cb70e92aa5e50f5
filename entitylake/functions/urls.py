"""Entity ids carried by links, and the shape of request paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from entitylake import constants as K
from entitylake.functions import text as T


def url_path(url: Column) -> Column:
    """Path of an absolute URL; NULL for a relative one."""
    return F.when(
        url.rlike(K.ABSOLUTE_URL_PATTERN), F.regexp_extract(url, K.ABSOLUTE_URL_PATTERN, 1)
    )


def percent_decode(text: Column) -> Column:
    """Decode ``%xx`` but keep ``+``; a broken escape gives NULL."""
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def _id_from(url: Column, path_pattern: str, relative_pattern: str) -> Column:
    def find(href: Column) -> Column:
        return F.when(
            href.rlike(K.ABSOLUTE_URL_PATTERN),
            F.regexp_extract(
                F.regexp_extract(href, K.ABSOLUTE_URL_PATTERN, 1), path_pattern, 1
            ),
        ).otherwise(F.regexp_extract(href, relative_pattern, 1))

    return T.bind(
        percent_decode(T.bind(T.js_trim(url), find)), lambda found: F.when(found != "", found)
    )


def id_from_api_url(url: Column) -> Column:
    return _id_from(url, K.ENTITY_PATH_PATTERN, K.ENTITY_RELATIVE_PATTERN)


def id_from_ui_url(url: Column) -> Column:
    return _id_from(url, K.UI_PATH_PATTERN, K.UI_RELATIVE_PATTERN)


def canonical_id(body_id: Column, links: Column) -> Column:
    """The trimmed own id, else the first id found in the links (a string map)."""
    return F.coalesce(
        T.nonblank(body_id),
        *[id_from_api_url(F.try_element_at(links, F.lit(key))) for key in K.API_LINK_KEYS],
        id_from_ui_url(F.try_element_at(links, F.lit(K.UI_LINK_KEY))),
    )
