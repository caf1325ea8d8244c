"""Score tables of the hierarchical classifier, its losses and its training log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from carlot.functions import arrays as ar
from carlot.operators import heads, scores, training
from carlot.plans.fixtures import Views, node_of
from carlot.plans.sql_views import with_views


def _batch() -> Column:
    return scores.batch_of(F.col("image_id"))


def _softmax(views: Views, temperature: float) -> DataFrame:
    return scores.softmax_scores(views.scores, temperature).select(
        "image_id", "sample", "level", "node", F.posexplode("probs").alias("class_idx", "prob")
    ).withColumn("prob", F.round("prob", 6))


def _moments(views: Views) -> DataFrame:
    return scores.sample_mean_var(views.scores).select(
        "image_id", "level", "node", "class_idx",
        F.round("mean", 6).alias("mean"), F.round("variance", 8).alias("variance"),
    )


def _summary(views: Views) -> DataFrame:
    return scores.head_summary(scores.head_moments(views.scores))


def _decoded(views: Views) -> DataFrame:
    return scores.decode_top1(scores.head_moments(views.scores))


def _short_heads(views: Views) -> DataFrame:
    """Scores where the trim heads of even brands keep only their first class."""
    short = (F.col("level") == "trim") & (F.substring("node", 1, 1).isin("0", "2"))
    return views.scores.withColumn(
        "logits", F.when(short, F.slice("logits", 1, 1)).otherwise(F.col("logits"))
    )


def _status(views: Views) -> DataFrame:
    decoded = scores.decode_top1(scores.head_moments(_short_heads(views)))
    return scores.single_class_status(decoded).select("image_id", "brand_idx", "status")


def _bands(views: Views) -> DataFrame:
    return _summary(views).select(
        "image_id", "level", "node",
        scores.confidence_band(
            F.col("confidence") + 40, F.col("uncertainty") * 3
        ).alias("band"),
    )


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(
        "batch", *[F.round(c, 6).alias(c) for c in df.columns if c != "batch"]
    )


def _odd_labels(views: Views) -> DataFrame:
    """Labels with missing and out-of-range values."""
    i = F.col("image_id")
    return views.labels3.select(
        "image_id",
        F.when(i % 7 == 0, -1).otherwise(F.col("brand_idx")).alias("brand_idx"),
        F.when(i % 5 == 0, 3).when(i % 11 == 0, -1).otherwise(F.col("series_idx"))
        .alias("series_idx"),
        F.when(i % 13 == 0, 2).otherwise(F.col("trim_idx")).alias("trim_idx"),
    )


def _mixup(views: Views) -> DataFrame:
    rows = views.labels3.join(views.embeddings.select("image_id", "v"), "image_id")
    mixed = training.mixup(
        rows, "image_id", "v", ["brand_idx", "series_idx", "trim_idx"],
        lam=(F.col("batch") % 10 + 1) / 11,
    )
    total = F.aggregate("v", F.lit(0.0), lambda s, x: s + x)
    return mixed.withColumn("v", F.round(total, 6)).withColumn("lam", F.round("lam", 6))


def _beta_lambda(views: Views) -> DataFrame:
    """One draw per batch of images."""
    batches = views.labels3.select(_batch().alias("batch")).distinct()
    return batches.withColumn("lam", training.beta_lambda(F.col("batch")))


def _mixup_loss(views: Views) -> DataFrame:
    """The blend of both label sets' losses per batch."""
    rows = views.labels3.join(views.embeddings.select("image_id", "v"), "image_id")
    levels = ["brand_idx", "series_idx", "trim_idx"]
    mixed = training.mixup(
        rows, "image_id", "v", levels, lam=(F.col("batch") % 10 + 1) / 11
    )
    own = mixed.select("image_id", *levels)
    other = mixed.select("image_id", *[F.col(f"partner_{c}").alias(c) for c in levels])
    a = scores.hier_loss(views.single_scores, own, _batch()).select("batch", F.col("loss").alias("a"))
    b = scores.hier_loss(views.single_scores, other, _batch()).select(
        "batch", F.col("loss").alias("b")
    )
    weights = mixed.groupBy("batch").agg(F.min("lam").alias("lam"))
    return a.join(b, "batch").join(weights, "batch").select(
        "batch",
        F.round(training.mixup_loss(F.col("a"), F.col("b"), F.col("lam")), 6).alias("loss"),
    )


def _batches(views: Views) -> DataFrame:
    """A training log from orders: priority as run, month as epoch."""
    return views.table("orders").select(
        F.col("o_orderpriority").alias("run"),
        (F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1992 * 12).alias("epoch"),
        F.when(F.col("o_custkey") % 5 < 4, F.lit("train")).otherwise(F.lit("val")).alias("phase"),
        (F.col("o_totalprice") / 7).alias("loss"),
        F.lit(0.0001).alias("lr"),
        *[
            c
            for k, level in enumerate(("brand", "series", "trim"), start=5)
            for c in (
                (F.col("o_custkey") % k).alias(f"{level}_correct"),
                F.lit(k).alias(f"{level}_total"),
            )
        ],
    )


def _epochs(views: Views) -> DataFrame:
    made = training.epoch_metrics(_batches(views))
    return made.select(
        "run", "epoch",
        *[F.round(c, 4).alias(c) for c in made.columns if c not in ("run", "epoch")],
    )


def _best(views: Views) -> DataFrame:
    return training.best_epoch(training.epoch_metrics(_batches(views))).withColumn(
        "best_val_loss", F.round("best_val_loss", 4)
    )


def _saliency(views: Views) -> DataFrame:
    return scores.saliency_threshold(views.saliency).select(
        "image_id", "level", F.round("threshold", 6).alias("threshold"),
        F.posexplode(F.arrays_zip("damped", "mask")).alias("pos", "cell"),
    ).select(
        "image_id", "level", "threshold", "pos", F.round("cell.damped", 6).alias("damped"),
        F.col("cell.mask").alias("mask"),
    )


def _mean_abs(views: Views) -> DataFrame:
    """The vectors as four channels of sixteen cells."""
    channels = F.array(*[F.slice("v", 1 + 16 * k, 16) for k in range(4)])
    return views.embeddings.select(
        "image_id", F.posexplode(ar.mean_abs_channels(channels)).alias("pos", "value")
    ).withColumn("value", F.round("value", 6))


_WIDTH = 64


def _labelled(views: Views) -> DataFrame:
    """Vectors with their label as brand, and series and trim read off the vector."""
    sign = [(F.get("v", F.lit(i)) > 0).cast("int") for i in range(3)]
    return views.embeddings.select(
        "image_id", F.col("v").alias("features"), F.col("label").alias("brand_idx"),
        (sign[0] + sign[1]).alias("series_idx"), sign[2].alias("trim_idx"),
    )


def _heads(views: Views) -> DataFrame:
    return heads.train_node_heads(heads.node_rows(_labelled(views)), _WIDTH)


def _weights(views: Views) -> DataFrame:
    return _heads(views).select("node", F.posexplode("weights").alias("class_idx", "w")).select(
        "node", "class_idx", F.size("w").alias("width"), F.round(F.get("w", F.lit(64)), 4)
        .alias("bias"),
    )


def _scored(views: Views) -> DataFrame:
    """Share of right classes per level, each head against the class it always sees most."""
    rows, trained = _labelled(views), _heads(views)
    parts = None
    for level in ("brand", "series", "trim"):
        part = heads.score_node_heads(rows, trained, node_of(level), level).select(
            "image_id", "level", "node", "logits"
        )
        parts = part if parts is None else parts.unionByName(part)
    labels = rows.select("image_id", "brand_idx", "series_idx", "trim_idx")
    return scores.hier_accuracy(parts, labels)


QUERIES = {
    "softmax": lambda v: _softmax(v, 1.0),
    "softmax_temperature": lambda v: _softmax(v, 0.1),
    "sample_mean_var": _moments,
    "decode_top1": lambda v: _decoded(v).select("image_id", "brand_idx", "series_idx", "trim_idx"),
    "confidence_uncertainty": lambda v: _summary(v).select(
        "image_id", "level", "node", "class_idx", F.round("confidence", 4).alias("confidence"),
        F.round("uncertainty", 4).alias("uncertainty"),
    ),
    "confidence_band": _bands,
    "single_class_status": _status,
    "hier_accuracy": lambda v: scores.hier_accuracy(v.single_scores, v.labels3).withColumn(
        "accuracy", F.round("accuracy", 6)
    ),
    "hier_loss": lambda v: _rounded(scores.hier_loss(v.single_scores, v.labels3, _batch())),
    "masked_loss": lambda v: _rounded(
        scores.masked_loss(v.single_scores, _odd_labels(v), _batch())
    ),
    "mixup": _mixup,
    "mixup_loss": _mixup_loss,
    "beta_lambda": _beta_lambda,
    "mean_abs_channels": _mean_abs,
    "epoch_metrics": _epochs,
    "best_epoch": _best,
    "saliency_threshold": _saliency,
    "train_node_heads": _weights,
    "score_node_heads": _scored,
}

_DECODED = """
, decoded as (
  select b.image_id, b.class_idx as brand_idx, s.class_idx as series_idx, t.class_idx as trim_idx
  from head_best b
  join head_best s on s.image_id = b.image_id and s.level = 'series'
    and s.node = cast(b.class_idx as string)
  join head_best t on t.image_id = b.image_id and t.level = 'trim'
    and t.node = concat(cast(b.class_idx as string), '/', cast(s.class_idx as string))
  where b.level = 'brand')
"""


def _loss_steps(rows: str, gates: bool, smoothing: float, p: str = "") -> str:
    """Steps to the loss per batch over ``rows`` (one row per class of a judged head)."""
    sure = "and brand_top > 0.5" if gates else ""
    both = "and brand_top > 0.5 and series_top > 0.5" if gates else ""
    ce = (
        f"{1 - smoothing} * -max(case when class_idx = label then ln(prob) end) "
        f"+ {smoothing} * avg(-ln(prob))"
        if smoothing
        else "-max(case when class_idx = label then ln(prob) end)"
    )
    return f"""
, {p}ce as (select image_id, level, cast({ce} as double) as ce, max(top) as top
         from {rows} group by image_id, level),
{p}images as (select image_id // 32 as batch, image_id,
   max(case when level = 'brand' then ce end) as b, max(case when level = 'series' then ce end) as s,
   max(case when level = 'trim' then ce end) as t,
   max(case when level = 'brand' then top end) as brand_top,
   max(case when level = 'series' then top end) as series_top
   from {p}ce group by image_id),
{p}batches as (select batch, coalesce(avg(b), cast(0 as double)) as brand_loss,
   coalesce(avg(case when true {sure} then s end), cast(0 as double)) as series_loss,
   coalesce(avg(case when true {both} then t end), cast(0 as double)) as trim_loss
   from {p}images group by batch)
"""


def _loss_sql(views: list[str], rows: str, gates: bool, smoothing: float) -> str:
    return with_views(
        views,
        _loss_steps(rows, gates, smoothing)
        + """
select batch, round(brand_loss, 6) as brand_loss, round(series_loss, 6) as series_loss,
  round(trim_loss, 6) as trim_loss,
  round(brand_loss + cast(0.5 as double) * series_loss + cast(0.25 as double) * trim_loss, 6)
    as loss
from batches
""",
    )


_PAIRS = """
, spots as (select *, row_number() over (partition by image_id // 32 order by image_id) as rn,
  row_number() over (partition by image_id // 32
    order by md5(concat(cast(image_id as string), '|42'))) as mix from labels3),
partner as (select a.image_id, b.brand_idx, b.series_idx, b.trim_idx
  from spots a join spots b on a.image_id // 32 = b.image_id // 32 and a.rn = b.mix),
judged_b as (select p.*, case level when 'brand' then brand_idx when 'series' then series_idx
    else trim_idx end as label, max(prob) over (partition by image_id, level) as top
  from prob_long p join partner using (image_id)
  where sample = 0 and node = case level when 'brand' then ''
    when 'series' then cast(brand_idx as string)
    else concat(cast(brand_idx as string), '/', cast(series_idx as string)) end)
"""

_BLEND = "brand_loss + cast(0.5 as double) * series_loss + cast(0.25 as double) * trim_loss"

_MASKED_ROWS = """(
  select p.*, case level when 'brand' then brand_idx when 'series' then series_idx
      else trim_idx end as label,
    max(prob) over (partition by image_id, level) as top,
    count(*) over (partition by image_id, level) as n
  from prob_long p join (
    select image_id, case when image_id % 7 = 0 then -1 else brand_idx end as brand_idx,
      case when image_id % 5 = 0 then 3 when image_id % 11 = 0 then -1 else series_idx end
        as series_idx,
      case when image_id % 13 = 0 then 2 else trim_idx end as trim_idx from labels3) l
    using (image_id)
  where sample = 0 and node = case level when 'brand' then ''
    when 'series' then cast(brand_idx as string)
    else concat(cast(brand_idx as string), '/', cast(series_idx as string)) end)
"""

_LOG = """
with log as (
  select o_orderpriority as run, year(o_orderdate) * 12 + month(o_orderdate) - 1992 * 12 as epoch,
    o_custkey % 5 < 4 as train, o_totalprice / 7 as loss, o_custkey % 5 as b, o_custkey % 6 as s,
    o_custkey % 7 as t
  from orders),
epochs as (
  select run, epoch, avg(loss) filter (train) as train_loss,
    sum(b) filter (train) / (5 * count(*) filter (train)) as train_brand_acc,
    sum(s) filter (train) / (6 * count(*) filter (train)) as train_series_acc,
    sum(t) filter (train) / (7 * count(*) filter (train)) as train_trim_acc,
    avg(loss) filter (not train) as val_loss,
    sum(b) filter (not train) / (5 * count(*) filter (not train)) as val_brand_acc,
    sum(s) filter (not train) / (6 * count(*) filter (not train)) as val_series_acc,
    sum(t) filter (not train) / (7 * count(*) filter (not train)) as val_trim_acc
  from log group by run, epoch)
"""

_EPOCH_COLUMNS = [
    f"{p}_{m}" for p in ("train", "val") for m in ("loss", "brand_acc", "series_acc", "trim_acc")
]

SQL = {
    "softmax": with_views(
        ["prob_long"],
        "select image_id, sample, level, node, class_idx, round(prob, 6) as prob from prob_long",
    ),
    "softmax_temperature": with_views(
        ["score_long"],
        """
select image_id, sample, level, node, class_idx,
  round(e / sum(e) over (partition by image_id, sample, level, node), 6) as prob
from (select *, exp((logit - max(logit) over (partition by image_id, sample, level, node))
        / cast(0.1 as double)) as e from score_long)
""",
    ),
    "sample_mean_var": with_views(
        ["moments"],
        "select image_id, level, node, class_idx, round(mean, 6) as mean, "
        "round(variance, 8) as variance from moments",
    ),
    "decode_top1": with_views(
        ["head_best"], _DECODED + "select image_id, brand_idx, series_idx, trim_idx from decoded"
    ),
    "confidence_uncertainty": with_views(
        ["head_best"],
        "select image_id, level, node, class_idx, round(confidence, 4) as confidence, "
        "round(uncertainty, 4) as uncertainty from head_best",
    ),
    "confidence_band": with_views(
        ["head_best"],
        "select image_id, level, node, case when confidence + 40 > 90 and uncertainty * 3 < 5 "
        "then 'green' when confidence + 40 > 70 and uncertainty * 3 < 15 then 'orange' "
        "else 'red' end as band from head_best",
    ),
    "single_class_status": with_views(
        ["head_best"],
        "select image_id, class_idx as brand_idx, "
        "case when class_idx in (0, 2) then 'error' else 'ok' end as status "
        "from head_best where level = 'brand'",
    ),
    "hier_accuracy": with_views(
        ["judged"],
        """
select level, count(*) filter (class_idx = label) as correct, count(*) as total,
  round(count(*) filter (class_idx = label) / count(*), 6) as accuracy
from (select *, row_number() over (partition by image_id, level order by logit desc, class_idx)
        as rn from judged)
where rn = 1 group by level
""",
    ),
    "hier_loss": _loss_sql(["judged"], "judged", True, 0.1),
    "masked_loss": _loss_sql(
        ["prob_long", "labels3"],
        f"(select * from {_MASKED_ROWS} where label >= 0 and label < n)", False, 0.0,
    ),
    "mixup": with_views(
        ["labels3"],
        """
, a as (select *, image_id // 32 as batch,
  row_number() over (partition by image_id // 32 order by image_id) as rn,
  row_number() over (partition by image_id // 32
    order by md5(concat(cast(image_id as string), '|42'))) as mix
  from labels3 join vectors using (image_id)),
pairs as (select a.batch, cast((a.batch % 10 + 1) / 11 as double) as lam, a.image_id,
  b.image_id as partner, a.brand_idx, a.series_idx, a.trim_idx, b.brand_idx as partner_brand_idx,
  b.series_idx as partner_series_idx, b.trim_idx as partner_trim_idx, list_sum(a.v) as av,
  list_sum(b.v) as bv
  from a join a b on a.batch = b.batch and a.rn = b.mix)
select batch, round(lam, 6) as lam, image_id, partner, round(av * lam + bv * (1 - lam), 6) as v,
  brand_idx, series_idx, trim_idx, partner_brand_idx, partner_series_idx, partner_trim_idx
from pairs
""",
    ),
    "mixup_loss": with_views(
        ["judged"],
        _PAIRS
        + _loss_steps("judged", True, 0.1, "a_")
        + _loss_steps("judged_b", True, 0.1, "b_")
        + f"""
select batch, round(lam * a + (1 - lam) * b, 6) as loss
from (select batch, cast((batch % 10 + 1) / 11 as double) as lam, {_BLEND} as a from a_batches)
join (select batch, {_BLEND} as b from b_batches) using (batch)
""",
    ),
    "mean_abs_channels": with_views(
        ["vectors"],
        "select image_id, cast(i as int) as pos, round((abs(v[1 + i]) + abs(v[17 + i]) "
        "+ abs(v[33 + i]) + abs(v[49 + i])) / 4, 6) as value from vectors, range(0, 16) t(i)",
    ),
    "epoch_metrics": _LOG
    + "select run, epoch, cast(0.0001 as double) as lr, "
    + ", ".join(f"round({c}, 4) as {c}" for c in _EPOCH_COLUMNS)
    + " from epochs",
    "best_epoch": _LOG
    + """
, low as (select *, min(val_loss) over (partition by run order by epoch
    rows between unbounded preceding and 1 preceding) as low,
  row_number() over (partition by run order by epoch) as place from epochs),
better as (select *, low is null or val_loss < low as better from low),
waited as (select *, place - max(case when better then place end)
    over (partition by run order by epoch) as waited from better),
stops as (select *, min(case when waited >= 5 then place end) over (partition by run) as stop
  from waited)
select run, max(epoch) filter (better and (stop is null or place <= stop)) as best_epoch,
  round(min(val_loss) filter (better and (stop is null or place <= stop)), 4) as best_val_loss,
  min(epoch) filter (place = stop) as stop_epoch
from stops group by run
""",
    "saliency_threshold": with_views(
        ["vectors"],
        """
, cells as (select image_id, ['brand', 'series', 'trim'][1 + image_id % 3] as level,
  cast(i as int) as pos, v[i + 1] as x from vectors, range(0, 64) t(i)),
scaled as (select *, (x - min(x) over w) / (max(x) over w - min(x) over w + cast(1e-8 as double))
  as y from cells window w as (partition by image_id)),
cuts as (select image_id, case level when 'brand' then quantile_cont(y, 0.85)
  when 'series' then quantile_cont(y, 0.80) else quantile_cont(y, 0.75) end as cut
  from scaled group by image_id, level)
select image_id, level, round(cut, 6) as threshold, pos,
  round(case when y >= cut then y when level = 'brand' then cast(0 as double)
    when level = 'series' then y * cast(0.2 as double) else y * cast(0.3 as double) end, 6)
    as damped,
  case when y > cut then 1 else 0 end as mask
from scaled join cuts using (image_id)
""",
    ),
}
