"""Leak-free corrections and error measures of predicted volumes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import numbered, written

#: Fits and values of a block: each block of fits meets each block of values, in tasks of their own.
FITS, VALUES = 2_048, 16_384


def _totals(df: DataFrame, moments: dict[str, Column], fold: str) -> DataFrame:
    """Moments of all folds but the row's own: summed by fold, less from the sum over the folds (one row)."""
    by = df.groupBy(fold).agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(k) for k, c in moments.items()])
    every = by.agg(*[F.sum(k).alias(f"_all{k}") for k in moments])
    return by.crossJoin(F.broadcast(every)).select(fold, *[(F.col(f"_all{k}") - F.col(k)).alias(k) for k in moments])  # every: one row


def _dealt(rows: DataFrame, most: int, key: Column, columns: list[str]) -> DataFrame:
    """rows in blocks of about `most`, packed: a row for each block with an array for each column. The number of blocks follows the count."""
    blocks = -(-rows.count() // most)
    return rows.groupBy(F.pmod(key, F.lit(max(blocks, 1))).alias("_block")).agg(*[F.collect_list(c).alias(c) for c in columns])


def power_sums(fits: DataFrame, values: DataFrame, per_block: tuple[int, int] = (FITS, VALUES)) -> DataFrame:
    """fits(f int, e) and values(f int, x, w) -> f, s: the sum of w * exp(e * x) over the values of all other f, for each fit.

    Both sides are written tables without nulls, a value once for each (f, x). Every block of fits
    meets every block of values, both of bounded size; partial sums are added by fit. That is one
    exponential for each fit and value, over as many tasks as there are pairs of blocks.
    """
    left = written(_dealt(fits, per_block[0], F.xxhash64("f"), ["f", "e"]))
    right = _dealt(values, per_block[1], F.xxhash64("f", "x"), ["f", "x", "w"])
    blocks = [r[0] for r in left.select("_block").collect()]  # a number for each block of fits
    meet = right.select("f", "x", "w", F.explode(F.array(*map(F.lit, blocks)) if blocks else F.array().cast("array<bigint>")).alias("_block")).repartition("_block", F.xxhash64("x"))
    meet = meet.join(left.select("_block", F.col("f").alias("fit"), "e"), "_block").drop("_block")

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                f, x, w, fit, e = (batch.column(c)[k].values.to_numpy() for c in ("f", "x", "w", "fit", "e"))
                total = np.zeros(len(fit))
                for a in range(0, len(fit), 64):
                    part = np.exp(e[a : a + 64, None] * x[None])
                    part *= w
                    part[fit[a : a + 64, None] == f[None]] = 0.0
                    total[a : a + 64] = part.sum(1)
                yield pa.RecordBatch.from_arrays([pa.array(fit), pa.array(total)], ["f", "s"])

    return meet.mapInArrow(run, "f int, s double").groupBy("f").agg(F.sum("s").alias("s"))


def mean_of_others(df: DataFrame, value: Column) -> DataFrame:
    """Adds others: the mean of value over all other rows, null ones aside; null without another. One aggregate of one row is joined back."""
    known = df.withColumn("_v", value)
    every = known.agg(F.sum("_v").alias("_s"), F.count("_v").alias("_n"))
    own = F.col("_v").isNotNull().cast("int")
    mean = (F.col("_s") - F.coalesce("_v", F.lit(0.0))) / F.nullif(F.col("_n") - own, F.lit(0))
    return known.crossJoin(F.broadcast(every)).withColumn("others", mean).drop("_v", "_s", "_n")  # every: one row


def ratio_corrected(df: DataFrame, fold: str = "fold", actual: str = "actual", pred: str = "pred") -> DataFrame:
    """Adds corrected: pred by the other folds' sum of actual over sum of pred, if they have three rows and a positive sum."""
    ok = F.col(actual).isNotNull() & F.col(pred).isNotNull()
    rest = _totals(df, {"_n": ok.cast("double"), "_a": F.when(ok, F.col(actual)), "_p": F.when(ok, F.col(pred))}, fold)
    usable = (F.col("_n") >= 3) & (F.col("_p") > 0)
    out = df.join(rest, fold)  # Spark broadcasts it if it is small
    return out.withColumn("corrected", F.when(usable, F.col(pred) * F.col("_a") / F.when(usable, F.col("_p")))).drop("_n", "_a", "_p")


def power_corrected(df: DataFrame, fold: str = "fold", actual: str = "actual", pred: str = "pred") -> DataFrame:
    """Adds corrected and exponent: c * pred ** b fitted in logs on the other folds, b within 0.5 and 2.5, sums matched.

    Needs four usable rows in the other folds. The mean match sums c * pred ** b, which has no
    closed form, so those sums are made once b is known, block by block (power_sums), for any number of
    folds. A null fold is held out of nothing and gets null.
    """
    ok = F.col(actual).isNotNull() & (F.col(pred) > 0) & (F.col(actual) > 0)
    x, y = F.ln(F.when(ok, F.col(pred))), F.ln(F.when(ok, F.col(actual)))
    rest = _totals(df, {"_n": ok.cast("double"), "_x": x, "_y": y, "_xx": x * x, "_xy": x * y, "_a": F.when(ok, F.col(actual))}, fold)
    slope = (F.col("_n") * F.col("_xy") - F.col("_x") * F.col("_y")) / F.nullif(F.col("_n") * F.col("_xx") - F.col("_x") ** 2, F.lit(0.0))
    numbers = written(numbered(df.where(F.col(fold).isNotNull()), fold, "f"))
    fits = rest.where("_n >= 4").withColumn("raw", slope).where("raw is not null").select(
        F.col(fold), F.least(F.greatest("raw", F.lit(0.5)), F.lit(2.5)).alias("e"), ((F.col("_y") - F.col("raw") * F.col("_x")) / F.col("_n")).alias("_c"), "_a"
    )
    fits = written(fits.join(numbers, fold))
    used = df.where(ok).join(numbers, fold, "left").groupBy(F.coalesce("f", F.lit(0)).alias("f"), x.alias("x")).agg(F.count("*").cast("double").alias("w"))
    sums = power_sums(fits.select("f", "e"), written(used))
    match = F.col("_a") / F.greatest(F.exp("_c") * F.col("s"), F.lit(1e-9))
    fits = fits.join(sums, "f").select(F.col(fold), F.col("e").alias("exponent"), (match * F.exp("_c")).alias("_k"))
    out = df.join(fits, fold, "left").select(*[df[c] if c != fold else F.col(fold) for c in df.columns], "exponent", "_k")
    return out.withColumn("corrected", F.when(F.col(pred).isNotNull(), F.col("_k") * F.pow(F.greatest(F.col(pred), F.lit(0.0)), "exponent"))).drop("_k")


def quadratic_corrected(df: DataFrame, fold: str = "fold", actual: str = "actual", pred: str = "pred") -> DataFrame:
    """Adds corrected: a * pred + b * pred ** 2 through the origin on the other folds, sums matched; the plain ratio where the curve would turn."""
    ok = F.col(actual).isNotNull() & (F.col(pred) > 0)
    x, y = F.when(ok, F.col(pred)), F.when(ok, F.col(actual))
    m = {"_n": ok.cast("double"), "_x": x, "_y": y, "_x2": x**2, "_x3": x**3, "_x4": x**4, "_xy": x * y, "_x2y": x * x * y}
    rest = _totals(df, m, fold)
    tops = df.groupBy(fold).agg(F.max(x).alias("_m"))
    first = tops.agg(F.max(F.struct("_m", fold)).alias("_1"))
    second = tops.crossJoin(F.broadcast(first)).where(F.col(fold) != F.col(f"_1.{fold}")).agg(F.max("_m").alias("_2"))
    both = first.crossJoin(F.broadcast(second))  # one row: the greatest and what is greatest without its fold
    top = tops.crossJoin(F.broadcast(both)).select(fold, F.when(F.col(fold) == F.col(f"_1.{fold}"), F.col("_2")).otherwise(F.col("_1._m")).alias("_top")).where("_top is not null")
    det = F.nullif(F.col("_x2") * F.col("_x4") - F.col("_x3") ** 2, F.lit(0.0))
    a = (F.col("_xy") * F.col("_x4") - F.col("_x2y") * F.col("_x3")) / det
    b = (F.col("_x2") * F.col("_x2y") - F.col("_x3") * F.col("_xy")) / det
    fits = rest.join(top, fold).where("_n >= 4 and _x > 0").withColumns({"_a": a, "_b": b})
    bends = F.coalesce((F.col("_a") <= 0) | (F.col("_a") + 2 * F.col("_b") * F.col("_top") * 1.5 <= 0), F.lit(True))
    k = F.col("_y") / F.greatest(F.col("_a") * F.col("_x") + F.col("_b") * F.col("_x2"), F.lit(1e-9))
    fits = fits.select(F.col(fold).alias("_f"), F.when(bends, F.col("_y") / F.col("_x")).otherwise(k * F.col("_a")).alias("_p"), F.when(bends, 0.0).otherwise(k * F.col("_b")).alias("_q"))
    out = df.join(fits, df[fold] == fits["_f"], "left")
    return out.withColumn("corrected", F.col("_p") * F.col(pred) + F.col("_q") * F.col(pred) ** 2).drop("_f", "_p", "_q")


def leave_one_out(df: DataFrame, key: str, **how) -> DataFrame:
    """power_corrected() with every key a fold of its own, however many: each fit meets all other rows, in blocks."""
    return power_corrected(df, fold=key, **how)


def metrics(df: DataFrame, actual: str = "actual", pred: str = "pred", by: list[str] | None = None) -> DataFrame:
    """n, rmse, mae, bias, bias and WAPE in per cent, R2 (over two rows and some spread) and totals."""
    a, p = F.col(actual), F.col(pred)
    e = p - a
    known = df.where(a.isNotNull() & p.isNotNull())
    spread = F.var_pop(a) * F.count("*")
    return known.groupBy(*(by or [])).agg(
        F.count("*").alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), F.avg(e).alias("bias"),
        (100 * F.sum(e) / F.nullif(F.sum(a), F.lit(0.0))).alias("bias_pct"), (100 * F.sum(F.abs(e)) / F.nullif(F.sum(F.abs(a)), F.lit(0.0))).alias("wape_pct"),
        F.when((F.count("*") > 2) & (spread > 0), 1 - F.sum(e * e) / F.nullif(spread, F.lit(0.0))).alias("r2"),
        F.sum(a).alias("total_actual"), F.sum(p).alias("total_pred"),
    )


def iou(a: Column, b: Column) -> Column:
    """Overlap of two masks over rows; null for an empty union."""
    return F.count_if(a & b) / F.nullif(F.count_if(a | b), F.lit(0))


def recent(piles: DataFrame, factor: float, least: float | None = None) -> DataFrame:
    """piles(uav, v_ref, v_now, cover_ref, cover_now) -> adds change ratio and estimate: the surveyed volume by the
    model's change, else the model's volume by its factor; null where too little was seen."""
    change = F.when(F.col("v_ref") > 1, F.col("v_now") / F.greatest("v_ref", F.lit(1.0)))
    estimate = F.when(F.col("uav").isNotNull() & change.isNotNull(), F.col("uav") * change).otherwise(factor * F.col("v_now"))
    seen = F.lit(True) if least is None else (F.col("cover_ref") >= least) & (F.col("cover_now") >= least)
    return piles.withColumns({"change": F.when(seen, change), "estimate": F.when(seen, estimate)})
