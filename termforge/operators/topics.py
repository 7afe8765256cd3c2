"""Listing pages to topic URLs, topic pages to author, date and title."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termforge.functions.urls import absolute_url, canonical_url, is_vbulletin_topic, topic_id
from termforge.operators.html import parse, select

#: Listing pages of a phpBB forum and topics on each.
MAX_PAGES, PER_PAGE = 10, 25


def listing_urls(forums: DataFrame, pages: int = MAX_PAGES) -> DataFrame:
    """(forum_url, page, url) of the listing pages to read; a vBulletin forum has one."""
    last = F.when(F.upper("forum_type") == "PHPBB", pages - 1).otherwise(0)
    rows = forums.select("forum_url", F.explode(F.sequence(F.lit(0), last)).alias("page"))
    return rows.withColumn("url", F.when(F.col("page") == 0, F.col("forum_url")).otherwise(F.concat("forum_url", F.lit("&start="), (F.col("page") * PER_PAGE).cast("string"))))


def _links(batches, kind):
    import pyarrow as pa

    for batch in batches:
        hrefs, more = [], []
        for html in batch.column("html").to_pylist():
            root = parse(html or "")
            hrefs.append([n.attrs.get("href", "") for n in select(root, "a.topictitle" if kind == "PHPBB" else "a") if n.attrs.get("href")])
            more.append(any("next" in n.attrs.get("rel", "").split() for n in select(root, "a")))
        yield pa.RecordBatch.from_arrays([batch.column("forum_url"), batch.column("page"), pa.array(hrefs, pa.list_(pa.string())), pa.array(more)], ["forum_url", "page", "hrefs", "more"])


def topic_urls(listings: DataFrame, kind: str, base_url: str) -> DataFrame:
    """(forum_url, topic_seq, topic_url): distinct topics in order from (forum_url, page, html).

    A phpBB forum ends at its first page without topics or without a next page.
    """
    kind = kind.upper()
    if kind not in ("PHPBB", "VBULLETIN"):
        raise ValueError(f"unknown forum kind: {kind}")
    rows = listings.select("forum_url", F.col("page").cast("int").alias("page"), "html").mapInArrow(partial(_links, kind=kind), "forum_url string, page int, hrefs array<string>, more boolean")
    if kind == "PHPBB":
        ends = rows.groupBy("forum_url").agg(F.min(F.when(F.size("hrefs") == 0, F.col("page") - 1).when(~F.col("more"), F.col("page"))).alias("last"))
        rows = rows.join(ends, "forum_url").where("last is null or page <= last")
    links = rows.select("forum_url", "page", F.posexplode("hrefs").alias("pos", "href"))
    url = canonical_url(absolute_url(F.col("href"), base_url)) if kind == "PHPBB" else absolute_url(F.col("href"), base_url)
    links = links.select("forum_url", F.struct("page", "pos").alias("at"), url.alias("topic_url"))
    if kind == "VBULLETIN":
        links = links.where(is_vbulletin_topic(F.col("topic_url")))
    first = links.groupBy("forum_url", "topic_url").agg(F.min("at").alias("at"))
    seq = F.row_number().over(W.partitionBy("forum_url").orderBy("at")) - 1
    return first.withColumn("topic_seq", seq.cast("long")).select("forum_url", "topic_seq", "topic_url", topic_id(F.col("topic_url")).alias("topic_id"))


def page_metadata(html: str | None, kind: str, closed: bool = False) -> tuple[str | None, str | None, str | None, list[str]]:
    """Author, the text that may hold a date, title, and raw ``datetime`` attributes."""
    root = parse(html or "", closed)
    title = next((n.text() for n in select(root, "title")), None)
    if kind == "PHPBB":
        post = next(iter(select(root, "div.postbody")), None)
        author = next((n.text() for n in select(post, "strong")), None) if post else None
        return author, post.text() if post else None, title, []
    author = next((n.text() for n in select(root, "a.username")), None)
    return author, html, title, [n.attrs["datetime"] for n in root.walk() if "datetime" in n.attrs]


def _metadata(batches, kind, closed):
    import pyarrow as pa

    for batch in batches:
        author, about, title, stamps = zip(*(page_metadata(h, kind, closed) for h in batch.column("html").to_pylist()), strict=True) if batch.num_rows else ((), (), (), ())
        kept = [c for c in batch.schema.names if c != "html"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pa.array(author, pa.string()), pa.array(about, pa.string()), pa.array(title, pa.string()), pa.array(stamps, pa.list_(pa.string()))], [*kept, "author", "about", "title", "stamps"]
        )


def topic_metadata(pages: DataFrame, kind: str, closed: bool = False) -> DataFrame:
    """topic_url, author, creation_date and title from (topic_url, html). ``closed`` as in ``html.parse``."""
    kind = kind.upper()
    rows = pages.select("topic_url", "html").mapInArrow(partial(_metadata, kind=kind, closed=closed), "topic_url string, author string, about string, title string, stamps array<string>")
    if kind == "PHPBB":
        # The date follows the author's name behind a literal &raquo;, which parsed pages no longer hold.
        raw = F.regexp_extract("about", r"&raquo;\s*(\d{2}-\d{2}-\d{4} \d{2}:\d{2})", 1)
        date = F.try_to_timestamp(raw, F.lit("dd-MM-yyyy HH:mm")).cast("timestamp_ntz")
        cut = F.regexp_extract("title", "(?s)^(.+) - ", 1)
        title = F.trim(F.when(cut != "", cut).otherwise(F.col("title")))
    else:
        stamp = F.replace(F.get("stamps", F.lit(0)), F.lit(" "), F.lit("T"))
        plain = F.replace(F.regexp_extract("about", r"(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2})", 1), F.lit(" "), F.lit("T"))
        local = lambda c: F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss")), F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm"))).cast("timestamp_ntz")
        date, title = F.coalesce(local(stamp), local(plain)), F.trim("title")
    return rows.select("topic_url", "author", date.alias("creation_date"), title.alias("title"))
