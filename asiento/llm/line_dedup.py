"""Boilerplate lines by site-relative frequency (operator 6). DataFrame functions only.

For each host, the share of its pages that contain a line is the number of pages with the line by the
number of pages of the host. Lines whose share exceeds a ratio are boilerplate and dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asiento.llm.common import free_name, stored
from asiento.operators.joins import BROADCAST_BYTES, measured_bytes

#: A line on more than this share of the pages of its host is boilerplate. Much lower, the lines of a
#: document that a host holds in many copies would count as such, and all its copies be emptied.
RATIO = 0.1
#: A line on a single page is not repeated, whatever its share of a host with few pages. A caller may ask for more.
LEAST_PAGES = 2


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _digest(line: Column) -> Column:
    """A line is known by 128 bits of its trimmed text, so no text is shuffled."""
    return F.unhex(F.md5(line))


def boilerplate(
    pages: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
    copies_once: bool = False,
) -> DataFrame:
    """``host, lines``: the digests of the boilerplate lines of each host that has any.

    A host has less than (mean number of different lines of its pages) / ``ratio`` of them, so the lists
    are short. Pages are counted before the shuffle: a hot host, or a hot line, is as many rows as tasks.
    ``copies_once`` counts the equal texts of a host as one page; the digests of their lines are shuffled.
    """
    rows = pages.select(F.col(host).alias("host"), F.col(text).alias("text")).filter("host is not null")
    lines = F.array_distinct(F.filter(F.transform(_lines(F.col("text")), F.trim), lambda line: line != ""))
    if copies_once:
        digests = rows.select("host", _digest(F.col("text")).alias("page"), F.transform(lines, _digest).alias("lines"))
        rows = stored(digests.groupBy("host", "page").agg(F.first("lines").alias("lines")), "different_pages")
        seen = rows.select("host", F.explode("lines").alias("line"))
    else:
        seen = rows.select("host", F.explode(lines).alias("line")).select("host", _digest(F.col("line")).alias("line"))
    totals = rows.groupBy("host").agg(F.count("*").alias("total"))
    counts = seen.groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") >= least_pages)
    # One row per host; the line counts are the larger side and are spread by their line.
    if measured_bytes(totals) <= BROADCAST_BYTES:
        shares = counts.join(F.broadcast(totals), "host")
    else:
        shares = counts.join(totals, "host")
    return shares.filter(F.col("n") > ratio * F.col("total")).groupBy("host").agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(
    pages: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
    dropped: str = "dropped_lines",
    copies_once: bool = False,
) -> DataFrame:
    """``pages`` with the boilerplate lines taken out of ``text``, and their number as a further column.

    Lines end at ``\\n`` and are compared trimmed of blanks; blank lines are never boilerplate. What is
    left is joined by ``\\n`` as it was. A text of boilerplate only becomes empty; its row stays. A null
    text stays null; rows without a host are of no site and stay as they are. A repeated row counts as a
    page of its own, unless ``copies_once``: then the equal texts of a host count as one page. No rows give no
    rows. Further columns pass through; if ``dropped_lines`` is taken, dropped_lines_2 is used.
    """
    found = stored(boilerplate(pages, host, text, ratio, least_pages, copies_once), "boilerplate")
    count, key, lines = (free_name(pages.columns, name) for name in (dropped, "host_key", "host_lines"))
    found = found.select(F.col("host").alias(key), F.col("lines").alias(lines))
    if measured_bytes(found) <= BROADCAST_BYTES:
        joined = pages.join(F.broadcast(found), F.col(host) == F.col(key), "left")
    else:  # too many hosts to send to all: the few lines of a host are repeated, so a hot host is spread
        salt, other = (free_name([*pages.columns, key, lines], name) for name in ("salt", "other_salt"))
        spread = pages.withColumn(salt, F.pmod(F.xxhash64(text), F.lit(64)))
        salted = found.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(63))))
        joined = spread.join(salted, (F.col(host) == F.col(key)) & (F.col(salt) == F.col(other)), "left")
    parts = _lines(F.col(text))
    kept = F.filter(parts, lambda line: ~F.array_contains(F.col(lines), _digest(F.trim(line))))
    left = free_name([*pages.columns, key, lines, count], "left_lines")
    changed = joined.withColumn(left, F.when(F.col(lines).isNotNull(), kept))
    n = F.coalesce(F.size(parts) - F.size(left), F.lit(0))
    return changed.select(
        *[
            F.coalesce(F.array_join(F.col(left), "\n"), F.col(text)).alias(c) if c.lower() == text.lower() else F.col(c)
            for c in pages.columns
        ],
        F.greatest(n, F.lit(0)).alias(count),
    )
