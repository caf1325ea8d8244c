"""What to fetch next, and what the fetch log says."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from carlot.operators.ordering import range_chunks
from carlot.schema import (
    DEFAULT_PAGES,
    OFFSET_PARAMETER,
    OFFSET_STEP,
    ROWS_PER_PAGE,
    SIZE_PARAMETER,
)


def site_page_count(buttons: DataFrame, requested: int = DEFAULT_PAGES) -> DataFrame:
    """Pages per site, from pager texts ``site, kind, text``.

    ``kind`` is ``pager`` (the element that names the last page), ``button``
    (any pager button) or ``total`` (a text with the number of ads).
    """
    text = F.regexp_replace(F.col("text"), r"(?U)^\s+|\s+$", "")
    number = F.when(text.rlike(r"^[+-]?[0-9]+$"), F.expr("try_cast(trim(text) as int)"))
    digits = F.expr("try_cast(regexp_replace(text, '[^0-9]', '') as bigint)")

    def of(kind: str, value: Column) -> Column:
        return F.max(F.when(F.col("kind") == kind, value))

    found = buttons.groupBy("site").agg(
        of("pager", number).alias("pager"),
        of("button", number).alias("button"),
        of("total", digits).alias("total"),
    )
    pages = F.coalesce(
        F.col("pager").cast("long"),
        F.when(F.col("button") > 1, F.col("button")).cast("long"),
        F.ceil(F.col("total") / ROWS_PER_PAGE),
        F.lit(DEFAULT_PAGES).cast("long"),
    )
    return found.select(
        "site", pages.alias("found"), F.greatest(F.lit(requested), pages).alias("pages")
    )


def crawl_frontier(
    sites: DataFrame, done: DataFrame, max_offset: int | None = None
) -> DataFrame:
    """Pages still to fetch, with their addresses.

    ``sites`` has ``site, kind, pages, base_url``: kind ``offset`` pages by row
    offset, any other kind names the page parameter.  ``done`` has ``site, page``
    of everything queued or fetched.  Offsets go as far as ``pages`` says, or to
    ``max_offset`` if given.
    """
    by_offset = F.col("kind") == "offset"
    pages = F.col("pages").cast("long")
    last = (pages - 1) * OFFSET_STEP if max_offset is None else F.lit(max_offset).cast("long")
    wanted = F.when(
        by_offset, F.sequence(F.lit(0).cast("long"), last,
                              F.lit(OFFSET_STEP).cast("long"))
    ).otherwise(F.sequence(F.lit(1).cast("long"), pages))
    first = F.when(F.col("base_url").contains("?"), F.lit("&")).otherwise(F.lit("?"))
    url = F.when(
        by_offset,
        F.concat(
            F.col("base_url"), first, F.lit(f"{OFFSET_PARAMETER}="), F.col("page").cast("string"),
            F.lit(f"&{SIZE_PARAMETER}={OFFSET_STEP}"),
        ),
    ).otherwise(
        F.concat(F.col("base_url"), first, F.col("kind"), F.lit("="), F.col("page").cast("string"))
    )
    return (
        sites.where((by_offset & (last >= 0)) | (~by_offset & (pages >= 1)))
        .select("site", "kind", "base_url", F.explode(wanted).alias("page"))
        .join(done.select("site", "page").distinct(), ["site", "page"], "left_anti")
        .select("site", "page", url.alias("url"))
    )


def fetch_log_audit(log: DataFrame, limit: int = 3, chunks: int | None = None) -> DataFrame:
    """Per site: completed pages, failures, and when ``limit`` failures came in a row.

    ``log`` has ``site, ts, page, ok``.  The log is cut into time ranges; every
    range is reduced to the shape of its failure runs, and the runs are stitched
    over the ranges of a site, so a site with most of the log is not one task.
    """
    ordered = Window.partitionBy("site", "chunk").orderBy("ts", "page")
    recent = ordered.rowsBetween(-(limit - 1), 0)
    failed = (~F.col("ok")).cast("int")
    inside = (
        range_chunks(log.select("site", "ts", "page", "ok"), ["site", "ts", "page"], chunks)
        .withColumn("place", F.row_number().over(ordered))
        .withColumn("recent", F.sum(failed).over(recent))
    )
    pieces = inside.groupBy("site", "chunk").agg(
        F.count(F.lit(1)).alias("size"),
        F.sum(failed).alias("failures"),
        F.min(F.when(F.col("ok"), F.col("place"))).alias("first_ok"),
        F.max(F.when(F.col("ok"), F.col("place"))).alias("last_ok"),
        F.min(F.when(F.col("recent") == limit, F.col("ts"))).alias("run_ts"),
        *[
            F.min(F.when(F.col("place") == k, F.col("ts"))).alias(f"ts{k}")
            for k in range(1, limit)
        ],
    )

    def stitch(state: Column, piece: Column) -> Column:
        lead = F.coalesce(piece["first_ok"] - 1, piece["size"])
        carried = [
            F.when((state["carry"] >= limit - k) & (lead >= k), piece[f"ts{k}"])
            for k in range(1, limit)
        ]
        here = F.least(piece["run_ts"], *carried) if carried else piece["run_ts"]
        return F.struct(
            F.coalesce(piece["size"] - piece["last_ok"], state["carry"] + piece["size"])
            .cast("long").alias("carry"),
            F.coalesce(state["stop"], here).alias("stop"),
        )

    ts_type = log.schema["ts"].dataType
    start = F.struct(F.lit(0).cast("long").alias("carry"), F.lit(None).cast(ts_type).alias("stop"))
    stitched = pieces.groupBy("site").agg(
        F.sum("failures").alias("failures"),
        # one entry per range, so at most the number of shuffle partitions
        F.array_sort(F.collect_list(F.struct("chunk", *pieces.columns[2:]))).alias("pieces"),
    ).select(
        "site", "failures", F.aggregate("pieces", start, stitch)["stop"].alias("stopped_at")
    )
    completed = (
        log.where("ok").select("site", "page").distinct()
        .groupBy("site").agg(F.count(F.lit(1)).alias("completed"))
    )
    return stitched.join(completed, "site", "left").select(
        "site", F.coalesce("completed", F.lit(0)).alias("completed"), "failures", "stopped_at"
    )
