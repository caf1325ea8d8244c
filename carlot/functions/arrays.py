"""Array arithmetic for scores, losses and saliency maps.

A lambda body is evaluated once per element, so whatever does not depend on the
element is bound first with ``let``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def array_sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def softmax(arr: Column, temperature: float = 1.0) -> Column:
    """Softmax of an array<double>, shifted by its maximum."""

    def weights(a: Column, top: Column) -> Column:
        return F.transform(a, lambda x: F.exp((x - top) / F.lit(float(temperature))))

    def share(w: Column) -> Column:
        return let(array_sum(w), lambda total: F.transform(w, lambda x: x / total))

    return let(arr, lambda a: let(F.array_max(a), lambda top: let(weights(a, top), share)))


def first_argmax(arr: Column) -> Column:
    """0-based position of the largest value; the first one wins a tie."""
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def log_sum_exp(arr: Column) -> Column:
    return let(
        arr,
        lambda a: let(
            F.array_max(a),
            lambda top: top
            + F.log(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))),
        ),
    )


def smoothed_cross_entropy(logits: Column, label: Column, smoothing: float = 0.0) -> Column:
    """Cross-entropy of one row against a label mixed with the uniform distribution."""

    def loss(lse: Column) -> Column:
        hit = lse - F.get(logits, label)
        if not smoothing:
            return hit
        spread = lse - array_sum(logits) / F.size(logits)
        return F.lit(1.0 - smoothing) * hit + F.lit(smoothing) * spread

    return let(log_sum_exp(logits), loss)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def min_max_scale(arr: Column, eps: float = 1e-8) -> Column:
    def scale(a: Column, low: Column, span: Column) -> Column:
        return F.transform(a, lambda x: (x - low) / span)

    return let(
        arr,
        lambda a: let(
            F.array_min(a),
            lambda low: let(
                F.array_max(a) - low + F.lit(eps), lambda span: scale(a, low, span)
            ),
        ),
    )


def percentile_of(arr: Column, share: Column) -> Column:
    """Linear-interpolation percentile of an array, share in 0..1."""
    spot = (F.size(arr) - 1) * share
    low = F.floor(spot).cast("int")

    def between(ordered: Column) -> Column:
        below = F.get(ordered, low)
        above = F.coalesce(F.get(ordered, low + 1), below)
        return below + (above - below) * (spot - low)

    return let(F.array_sort(arr), between)


def mean_abs_channels(channels: Column) -> Column:
    """Mean of absolute values over channels: array<array<double>> to array<double>."""
    zero = F.transform(F.get(channels, F.lit(0)), lambda x: F.lit(0.0))
    total = F.aggregate(
        channels, zero, lambda acc, ch: F.zip_with(acc, ch, lambda a, x: a + F.abs(x))
    )
    return let(F.size(channels), lambda n: F.transform(total, lambda x: x / n))
