"""Listing-shaped views derived from the given star-schema tables.

``Views`` builds them as DataFrames; ``SQL`` states the same views as common
table expressions for the comparison queries.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from carlot.functions.text import basename
from carlot.operators import cleaning
from carlot.operators.scores import series_node, trim_node
from carlot.schema import KEY_COLUMNS, LISTING_COLUMNS
from carlot.session import stage


#: Bytes of line item files per partition, about 200,000 rows.
SLICE = 4 << 20
#: Line items of one part, about half a slice, beyond which its key does not deal them.
BUSY = 100_000


def _text(c: Column, kind: str = "int") -> Column:
    return c.cast(kind).cast("string")


class Views:
    """DataFrame views over one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _bytes(self, name: str) -> int:
        """Size of a table's files; their content is not read."""
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
        return files.load(f"{self.sf_dir}/{name}.parquet").agg(F.sum("length")).first()[0] or 0

    @cached_property
    def slices(self) -> int:
        """Number of partitions of bounded size for rows of the line items, at least one per core."""
        cores = self.spark.sparkContext.defaultParallelism
        return max(cores, -(-self._bytes("lineitem") // SLICE))

    @cached_property
    def lineitem(self) -> DataFrame:
        """The line items in slices of bounded size, at least one per core.

        Listing rows are some twenty times as large as the line items they come from, so
        partitions of the scan's size, or those that adaptive execution joins, would spill.
        A part table too large to broadcast is joined by shuffle; the slices are then dealt
        by its key, which spares a second shuffle, but for the line items of busy parts.
        """
        rows = self.table("lineitem")
        if not self._shuffles_parts:
            return rows.repartition(self.slices, "l_orderkey", "l_linenumber")
        if self.busy_parts is not None:
            rows = rows.join(self.busy_parts, "l_partkey", "left_anti")
        return rows.repartition(self.slices, "l_partkey")

    @cached_property
    def _shuffles_parts(self) -> bool:
        limit = self.spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
        return self._bytes("part") > limit

    @cached_property
    def busy_parts(self) -> DataFrame | None:
        """Keys of parts with more than ``BUSY`` line items, at most one in ``BUSY`` of these.

        All line items of a part would meet in one slice; adaptive execution does not split
        slices of a given number.
        """
        counts = self.table("lineitem").where("l_partkey is not null").groupBy("l_partkey").count()
        found = stage(counts.where(F.col("count") > BUSY).select("l_partkey"), "busy-parts")
        return None if found.isEmpty() else found

    @cached_property
    def listing_raw(self) -> DataFrame:
        rows = self._listings(self.lineitem, self.table("part"))
        if not self._shuffles_parts or self.busy_parts is None:
            return rows
        # the few busy parts are written, so that the planner sees that they can be broadcast
        keys = self.busy_parts
        parts = self.table("part")
        parts = stage(parts.join(keys, F.col("p_partkey") == F.col("l_partkey"), "left_semi"), "parts")
        busy = self.table("lineitem").join(keys, "l_partkey", "left_semi")
        busy = busy.repartition(self.slices, "l_orderkey", "l_linenumber")
        return rows.unionByName(self._listings(busy, parts))

    @cached_property
    def listing_images(self) -> DataFrame:
        """Places and image paths of ``listing_raw``, narrow rows that need no slices."""
        return self._listings(self.table("lineitem"), self.table("part")).select("page", "idx", "image_path")

    def _listings(self, lineitem: DataFrame, part: DataFrame) -> DataFrame:
        order, size = F.col("l_orderkey"), F.col("p_size")
        site = F.col("site")
        mercedes = F.col("p_brand") == "Brand#7"
        thousands = F.lpad((order % 1000).cast("string"), 3, "0")
        price = F.concat(
            _text(F.floor(F.col("l_extendedprice") / 15)), F.lit("."),
            F.lpad((F.col("l_partkey") % 1000).cast("string"), 3, "0"),
            F.when(site == 2, F.lit(" ₺")).otherwise(F.lit(" TL")),
        )
        path = F.concat(
            F.lit("data/images/car_"), order.cast("string"), F.lit("_idx_"),
            F.col("l_linenumber").cast("string"), F.lit("_"), F.col("l_partkey").cast("string"),
            F.lit(".jpg"),
        )
        joined = (
            lineitem.withColumn("site", (order % 4).cast("int"))
            .join(part, F.col("p_partkey") == F.col("l_partkey"))
            .join(self.table("supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
            .join(self.table("nation"), F.col("n_nationkey") == F.col("s_nationkey"))
        )
        base = joined.select(
            "site",
            order.alias("page"),
            ((F.col("l_linenumber").cast("long") * 10000 + F.col("l_suppkey")) * 1000000
             + F.col("l_partkey")).alias("idx"),
            F.when(order % 1000 == 0, F.concat(F.lit("Rare#"), _text(F.col("l_suppkey") % 20)))
            .when(mercedes & (site == 1), F.lit("Mercedes - Benz"))
            .when(mercedes, F.lit("Mercedes-Benz"))
            .otherwise(F.col("p_brand")).alias("marka"),
            F.col("p_type").alias("seri"),
            F.when((site == 0) & (size < 10), F.concat(F.lit("Serisi "), "p_name"))
            .when((site == 2) & (size < 3), F.concat("p_name", F.lit(" Serisi")))
            .otherwise(F.col("p_name")).alias("model"),
            F.concat(
                "p_brand", F.lit(" "), "p_type", F.lit(" "), "p_name", F.lit(" no "),
                F.col("l_suppkey").cast("string"), F.lit("/"),
                _text(F.round(F.col("l_extendedprice") * 100), "bigint"),
            ).alias("baslik"),
            (1985 + size % 40).cast("string").alias("yil"),
            F.concat(
                (F.floor("l_quantity").cast("int") * (order % 11)).cast("string"), F.lit("."),
                thousands, F.when(site == 3, F.lit("")).otherwise(F.lit(" km")),
            ).alias("km"),
            F.when((F.col("l_linenumber") == 7) & (site == 1), F.lit("N/A")).otherwise(price)
            .alias("fiyat"),
            F.concat("s_name", F.lit(" / "), "n_name").alias("il_ilce"),
            F.when(order % 97 != 0, path).alias("image_path"),
        )
        # every 50th page once more, under new keys and image names
        copies = F.when(F.col("page") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
            F.array(F.lit(0))
        )
        second = F.col("copy") == 1
        return base.withColumn("copy", F.explode(copies)).withColumns(
            {
                "idx": F.when(second, F.col("idx") + 1000000000000).otherwise(F.col("idx")),
                "image_path": F.when(
                    second, F.replace("image_path", F.lit(".jpg"), F.lit("_copy.jpg"))
                ).otherwise(F.col("image_path")),
            }
        ).select(*KEY_COLUMNS, *LISTING_COLUMNS)

    @cached_property
    def failed_images(self) -> DataFrame:
        return stage(
            self.listing_images.where((F.col("page") % 13 == 0) & F.col("image_path").isNotNull())
            .select(basename(F.col("image_path")).alias("basename")).distinct(),
            "failed-images",
        )

    @cached_property
    def image_files(self) -> DataFrame:
        return stage(
            self.listing_images.where((F.col("page") % 17 != 0) & F.col("image_path").isNotNull())
            .groupBy(basename(F.col("image_path")).alias("basename"))
            .agg(
                F.min(100 + F.col("page") % 900).cast("int").alias("width"),
                F.min(80 + F.col("idx") % 700).cast("int").alias("height"),
            ),
            "image-files",
        )

    @cached_property
    def listing_clean(self) -> DataFrame:
        return cleaning.clean_listings(self.listing_raw, self.image_files, self.failed_images)

    @cached_property
    def embeddings(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").alias("image_id"), F.col("label").cast("int").alias("label"),
            F.col("embedding").cast("array<double>").alias("v"),
        )

    @cached_property
    def image_pixels(self) -> DataFrame:
        return self.embeddings.select(
            "image_id", F.lit(4).alias("width"), F.lit(4).alias("height"),
            F.transform(
                F.slice("v", 1, 48),
                lambda x: F.least(F.lit(255), F.floor(F.abs(x) * 600).cast("int")),
            ).alias("pixels"),
        )

    @cached_property
    def detections(self) -> DataFrame:
        masks = F.array(
            *[
                F.struct(
                    F.lit(m).alias("mask_id"),
                    F.transform(
                        F.slice("v", 1 + 16 * m, 16), lambda x: (x > 0).cast("double")
                    ).alias("mask"),
                )
                for m in range(3)
            ]
        )
        return self.embeddings.select("image_id", F.inline(masks)).select(
            "image_id", "mask_id",
            ((F.col("image_id") + F.col("mask_id")) % 8).cast("int").alias("class_id"), "mask",
        )

    @cached_property
    def scores(self) -> DataFrame:
        """Ten scaled samples of 17 heads: 4 brands, 3 series each, 2 trims each."""
        heads = [("brand", "", 1, 4)]
        heads += [("series", str(b), 5 + 3 * b, 3) for b in range(4)]
        heads += [
            ("trim", f"{b}/{s}", 17 + 2 * (3 * b + s), 2) for b in range(4) for s in range(3)
        ]
        rows = F.array(
            *[
                F.struct(
                    F.lit(level).alias("level"), F.lit(node).alias("node"),
                    F.slice("v", start, size).alias("raw"),
                )
                for level, node, start, size in heads
            ]
        )
        scale = 1 + F.col("sample") / 10
        return (
            self.embeddings.select("image_id", F.inline(rows))
            .withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(9))))
            .select(
                "image_id", "sample", "level", "node",
                F.transform("raw", lambda x: x * scale).alias("logits"),
            )
        )

    @cached_property
    def single_scores(self) -> DataFrame:
        """The first sample only: one prediction per image, as in training."""
        return self.scores.where("sample = 0").drop("sample")

    @cached_property
    def labels3(self) -> DataFrame:
        return self.embeddings.select(
            "image_id",
            (F.col("label") % 4).cast("int").alias("brand_idx"),
            (F.col("image_id") % 3).cast("int").alias("series_idx"),
            (F.col("image_id") % 2).cast("int").alias("trim_idx"),
        )

    @cached_property
    def saliency(self) -> DataFrame:
        level = F.element_at(
            F.array(F.lit("brand"), F.lit("series"), F.lit("trim")),
            (F.col("image_id") % 3 + 1).cast("int"),
        )
        return self.embeddings.select("image_id", level.alias("level"), F.col("v").alias("values"))

    @cached_property
    def fetch_log(self) -> DataFrame:
        return self.table("events").select(
            (F.col("user_id") % 4).cast("int").alias("site"), "ts",
            F.col("event_id").alias("page"), (F.col("event_type") != "error").alias("ok"),
        )

    @cached_property
    def rendered_pages(self) -> DataFrame:
        """Every page of ``listing_raw`` as HTML in the dialect of its site."""
        return render_pages(self.listing_raw, 4 * self.slices)


def _escape(c: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


def _row_markup() -> Column:
    """Markup of one listing in the dialect of its site."""
    e = {c: _escape(F.col(c)) for c in LISTING_COLUMNS}
    src = F.coalesce(F.col("image_path"), F.lit("data/images/none.jpg"))
    img = F.concat(F.lit('<img class="ad-image" src="'), src, F.lit('">'))

    def td(c) -> Column:
        return F.concat(F.lit("<td> "), c, F.lit("\n</td>"))

    cells9 = F.concat(
        F.lit("<tr>"), td(F.concat(F.lit('<a href="#">'), img, F.lit("</a>"))),
        *[td(e[c]) for c in ("marka", "seri", "model", "baslik", "yil", "km", "fiyat")],
        td(F.lit("1 Ocak")), td(e["il_ilce"]), F.lit("</tr>"),
    )
    cells8 = F.concat(
        F.lit("<tr>"), td(F.concat(F.lit('<a href="#">'), img, F.lit("</a>"))),
        td(F.concat_ws(" ", e["marka"], e["seri"], e["model"])),
        *[td(e[c]) for c in ("baslik", "yil", "km")], td(F.lit("Beyaz")),
        td(F.when(F.col("fiyat") == "N/A", F.lit("")).otherwise(
            F.concat(F.lit("9.999.999 TL<br>"), e["fiyat"]))),
        td(F.lit("1 Ocak")), td(e["il_ilce"]), F.lit("</tr>"),
    )
    card = F.concat(
        F.lit('<div class="do-vehicle-card__container"><figure class="do-vehicle-card__figure">'),
        img, F.lit('</figure><h3 class="do-vehicle-card__title"><strong>'), e["marka"],
        F.lit("</strong> <span>"), e["seri"],
        F.lit('</span></h3><p class="do-vehicle-card__summary">'), e["model"],
        F.lit('</p><p class="do-vehicle-card__specs-summary">'), e["yil"], F.lit(", "), e["km"],
        F.lit(', Dizel</p><p class="do-vehicle-card__price">'),
        F.replace(e["fiyat"], F.lit(" ₺"), F.lit("")),
        F.lit('<br>indirim</p><p class="do-vehicle-card__footer-title">Galeri, '), e["il_ilce"],
        F.lit("</p></div>"),
    )
    grid = F.concat(
        F.lit('<section class="product-card horizontal-card"><div class="swiper-slide">'), img,
        F.lit('</div><div class="advert-title">'), e["marka"], F.lit(" - "), e["seri"],
        F.lit(" - "), e["model"],
        F.lit('</div><ul class="propertyGrid"><li><span class="propertyName" title="'), e["km"],
        F.lit(' km">x</span></li><li><span class="propertyName">'), e["il_ilce"],
        F.lit('</span></li></ul><small class="description">'), e["yil"],
        F.lit(' Model, Beyaz</small><div class="text-xs"><span class="text-lg">'),
        F.replace(e["fiyat"], F.lit(" TL"), F.lit("")), F.lit("</span></div></section>"),
    )
    site = F.col("site")
    return (
        F.when(site == 0, cells9).when(site == 1, cells8).when(site == 2, card).otherwise(grid)
    )


def render_pages(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """``site, page, html``: the listings of a page in key order.

    A page is one order of the source tables, a handful of rows.  Its markup is long but
    shrinks in the shuffle, and reading it is slow, so ``parts`` may name more partitions
    than adaptive execution would leave.
    """
    body = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("idx", "markup"))), lambda x: x["markup"]),
        "",
    )
    site = F.col("site")
    marked = rows.select("site", "page", "idx", _row_markup().alias("markup"))
    if parts:
        marked = marked.repartition(parts, "site", "page")
    return (
        marked.groupBy("site", "page")
        .agg(body.alias("body"))
        .select(
            "site",
            "page",
            F.when(
                site == 0,
                F.concat(F.lit('<table id="searchResultsTable"><tbody><tr></tr>'), "body",
                         F.lit("</tbody></table>")),
            )
            .when(
                site == 1,
                F.concat(F.lit('<table class="table listing-table"><tr><td>Model</td></tr>'),
                         "body", F.lit("</table>")),
            )
            .otherwise(F.concat(F.lit("<main>"), "body", F.lit("</main>"))).alias("html"),
        )
    )


def node_of(level: str) -> Column:
    """Node of the true parent for a labelled row."""
    if level == "brand":
        return F.lit("")
    if level == "series":
        return series_node(F.col("brand_idx"))
    return trim_node(F.col("brand_idx"), F.col("series_idx"))
