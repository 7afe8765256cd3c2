"""Topic URLs: canonical form, absolute form, topic id, forum kinds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_url(url: Column) -> Column:
    """Without paging, session and fragment."""
    for pattern in (r"&start=\d+", r"&sid=[^&]+", r"#.*$"):
        url = F.regexp_replace(url, pattern, "")
    return url


def absolute_url(url: Column, base: str | Column) -> Column:
    base = F.lit(base) if isinstance(base, str) else base
    rest = F.when(url.startswith("./"), F.substr(url, F.lit(3))).when(url.startswith("/"), F.substr(url, F.lit(2))).otherwise(url)
    return F.when(url.startswith("http"), url).otherwise(F.concat(F.regexp_replace(base, "/$", ""), F.lit("/"), rest))


def topic_id(url: Column) -> Column:
    """The first ``t=`` part, else the first ``p=`` part, else empty."""
    parts = F.split(url, "[?&]")
    first = lambda key: F.substr(F.get(F.filter(parts, lambda x: x.startswith(key)), F.lit(0)), F.lit(3))
    return F.coalesce(first("t="), first("p="), F.lit(""))


# The forum kinds.
FORUM_KINDS = ("PHPBB", "VBULLETIN")


def forum_kind(name: Column) -> Column:
    """The kind in upper case; null or unknown is an error."""
    upper = F.upper(name)
    return F.when(upper.isin(*FORUM_KINDS), upper).otherwise(F.raise_error(F.concat(F.lit("unknown forum kind: "), F.coalesce(name, F.lit("null")))))


def is_vbulletin_topic(url: Column) -> Column:
    return url.contains("showthread.php?t=") | url.rlike(r"/threads/.+\.\d+")
