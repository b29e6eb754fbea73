"""URL filtering against dated lists: was an address listed when it was fetched?

A list is a log of dated entries: from its day on, a pattern is blocked,
allowed, or no longer listed. The log becomes validity intervals (an entry
holds until the pattern's next one), and each capture is joined as of its
day with the entries of its patterns: its host, the host's parent domains,
and the host with each leading part of the path. The longest pattern active
on that day decides.

Intervals are cut at the ends of periods of ``PERIOD`` days and joined on
pattern and period, so that a pattern with a long history is met only with
the entries around the capture's day. Only addresses go through the join,
and one host or pattern with a third of all captures is split by Spark, since
the list's side has one row for each pattern and entry of a period.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starfold.llm.base import staged, table

PERIOD = 30
ACTIONS = ("allow", "block", "remove")


def host_of(url: Column) -> Column:
    """Lower-case host of an address, without user, port and trailing dot; empty if there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.rtrim(F.lower(host), F.lit("."))


def path_of(url: Column) -> Column:
    """Path of an address without query and fragment."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def patterns(url: Column) -> Column:
    """All patterns that match an address: ``a.b.c``, ``b.c``, ``c``, ``a.b.c/x``, ``a.b.c/x/y``, ..."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    parts = F.filter(F.split(path_of(url), "/"), lambda p: p != "")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    paths = F.when(F.size(parts) > 0, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1))),
        lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, i), "/")))).otherwise(F.array().cast("array<string>"))
    return F.when(host != "", F.array_distinct(F.concat(domains, paths))).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """``pattern, action, since, until`` of a log ``pattern, action, since``; ``until`` is null while an entry holds.

    Of several entries for a pattern and day the first of allow, block,
    remove counts. Rows with a null, or with an unknown action, are ignored.
    """
    e = entries.select("pattern", "action", "since").where(
        F.col("pattern").isNotNull() & F.col("since").isNotNull() & F.col("action").isin(*ACTIONS))
    e = e.groupBy("pattern", "since").agg(F.min("action").alias("action"))  # one row for each pattern and day
    until = F.lead("since").over(Window.partitionBy("pattern").orderBy("since"))
    return e.withColumn("until", until).where("action <> 'remove'")


def list_join(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
              day_col: str = "fetched") -> DataFrame:
    """One row for each capture: is it blocked, and by which entry?

    The longest active pattern decides; one that allows makes an exception
    from a shorter one that blocks. A capture without a host or with a null
    day is not blocked. Captures are decided row by row, so repeated rows and
    null ids come back as they are; further columns are ignored, whatever
    their names. An empty list blocks nothing.

    Columns: ``page_id, fetched, blocked, pattern, since`` (the last two null
    where no entry is active).
    """
    c = captures.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_url"), F.col(day_col).alias("fetched"))
    c = staged(c.withColumn("_row", F.monotonically_increasing_id()), "captures")  # numbered once, for both uses
    last = c.agg(F.max("fetched")).first()[0]
    c = c.withColumn("_patterns", patterns(F.col("_url")))
    period = lambda day: F.floor(F.unix_date(day) / F.lit(PERIOD))
    active = intervals(entries).where(F.col("since") <= F.lit(last).cast("date"))
    through = F.least(F.date_sub(F.coalesce("until", F.date_add(F.lit(last).cast("date"), 1)), 1), F.lit(last).cast("date"))
    active = active.withColumn("period", F.explode(F.sequence(period(F.col("since")), period(through))))
    wanted = c.where("fetched is not null").select(
        "_row", "fetched", period(F.col("fetched")).alias("period"), F.explode("_patterns").alias("pattern"))
    hits = wanted.join(active, ["pattern", "period"]).where("since <= fetched and (until is null or fetched < until)")
    best = hits.groupBy("_row").agg(F.max(F.struct(F.length("pattern").alias("n"), "pattern", "action", "since")).alias("hit"))
    return c.drop("_url", "_patterns").join(best, "_row", "left").select(
        "page_id", "fetched", F.coalesce(F.col("hit.action") == "block", F.lit(False)).alias("blocked"),
        F.col("hit.pattern").alias("pattern"), F.col("hit.since").alias("since"))


def _number(text: Column, at: int) -> Column:
    """A number below 2**20 from five hexadecimal digits of a text's MD5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), at, 5), 16, 10).cast("int")


def page_captures(pages: DataFrame) -> DataFrame:
    """The pages with a day of capture in 2024, fixed by the page's id."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), _number(F.coalesce(F.col("page_id").cast("string"), F.lit("")), 1) % 366)
    return pages.select("page_id", "url", day.alias("fetched"))


def page_lists(pages: DataFrame) -> DataFrame:
    """A dated list over all hosts, domains and first path parts of the pages.

    Each pattern's MD5 decides what happens to it and when: some are blocked
    from a day on, some of those allowed or removed later.
    """
    url = F.col("url")
    host, parts = host_of(url), F.filter(F.split(path_of(url), "/"), lambda p: p != "")
    names = F.array(host, F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1),
                    F.concat(host, F.lit("/"), F.coalesce(F.get(parts, F.lit(0)), F.lit(""))))
    p = pages.select(F.explode(names).alias("pattern")).where("pattern <> '' and pattern not like '%/' and pattern not like '/%'").distinct()
    n, day = _number(F.col("pattern"), 1), F.date_add(F.lit("2024-01-01").cast("date"), _number(F.col("pattern"), 6) % 200)
    log = F.array(
        F.when(n % 3 == 0, F.struct(F.lit("block").alias("action"), day.alias("since"))),
        F.when(n % 5 == 0, F.struct(F.lit("allow").alias("action"), F.date_add(day, 40).alias("since"))),
        F.when(n % 7 < 3, F.struct(F.lit("remove").alias("action"), F.date_add(day, 90).alias("since"))),
        F.when(n % 9 == 0, F.struct(F.lit("block").alias("action"), F.date_add(day, 120).alias("since"))),
    )
    return p.select("pattern", F.explode(F.filter(log, lambda x: x.isNotNull())).alias("e")).select("pattern", "e.action", "e.since")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the list entries active on its day of capture."""
    pages = table(spark, sf_dir, "pages")
    return list_join(page_captures(pages), page_lists(pages))


_HOST = r"rtrim(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '.')"
_PARTS = (r"list_filter(string_split(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), "
          r"lambda x: x <> '')")
_DAY = "CAST('2024-01-01' AS DATE) + CAST(('0x' || substr(md5({0}), {1}, 5)) AS INT) % {2}"
_N = "CAST(('0x' || substr(md5(pattern), 1, 5)) AS INT)"
SQL = {"op6_url_filter": f"""
    WITH p AS (
        SELECT page_id, {_HOST} AS host, {_PARTS} AS parts,
               {_DAY.format("coalesce(CAST(page_id AS VARCHAR), '')", 1, 366)} AS fetched FROM pages),
    names AS (
        SELECT host AS pattern FROM p UNION SELECT regexp_extract(host, '([^.]+\\.[^.]+)$', 1) FROM p
        UNION SELECT host || '/' || parts[1] FROM p WHERE len(parts) > 0),
    days AS (
        SELECT pattern, {_N} AS n, {_DAY.format("pattern", 6, 200)} AS day
        FROM names WHERE pattern <> '' AND pattern NOT LIKE '/%'),
    log AS (
        SELECT pattern, 'block' AS action, day AS since FROM days WHERE n % 3 = 0
        UNION ALL SELECT pattern, 'allow', day + 40 FROM days WHERE n % 5 = 0
        UNION ALL SELECT pattern, 'remove', day + 90 FROM days WHERE n % 7 < 3
        UNION ALL SELECT pattern, 'block', day + 120 FROM days WHERE n % 9 = 0),
    listed AS (
        SELECT pattern, action, since, lead(since) OVER (PARTITION BY pattern ORDER BY since) AS until FROM log),
    wanted AS (
        SELECT DISTINCT page_id, fetched, pattern FROM (
            SELECT page_id, fetched, unnest(list_transform(range(1, len(string_split(host, '.')) + 1),
                   lambda i: array_to_string(string_split(host, '.')[i:], '.'))) AS pattern FROM p
            UNION ALL SELECT page_id, fetched, unnest(list_transform(range(1, len(parts) + 1),
                   lambda i: host || '/' || array_to_string(parts[1:i], '/'))) FROM p WHERE host <> '') q),
    hits AS (
        SELECT page_id, pattern, action, since,
               row_number() OVER (PARTITION BY page_id ORDER BY length(pattern) DESC, pattern DESC) AS rn
        FROM wanted JOIN listed USING (pattern)
        WHERE action <> 'remove' AND since <= fetched AND (until IS NULL OR fetched < until))
    SELECT p.page_id, p.fetched, coalesce(h.action = 'block', false) AS blocked, h.pattern, h.since
    FROM p LEFT JOIN hits h ON h.page_id = p.page_id AND h.rn = 1"""}
QUERIES = {"op6_url_filter": op6_url_filter}
