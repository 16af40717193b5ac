"""Mixing sources to target weights with nested hash-threshold histograms. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracklake.llm.common import WORD
from tracklake.session import stage

LEVELS = 3
LEVEL_BITS = 10
_TOP = 1 << (LEVELS * LEVEL_BITS)


def word_count(text: Column) -> Column:
    """Words of a text, 0 if it is null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_point(key: Column) -> Column:
    """A number under 2**30 that depends on the key alone, the same in every run."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 8)
    return F.shiftright(F.conv(digits, 16, 10).cast("long"), 32 - LEVELS * LEVEL_BITS)


def source_targets(sized: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Columns source, source_size, target: `share` of all sizes by weight, none over `most` times its size.

    Sources are ordered by code point, null last, and get the weights in turn. The excess over a source's limit goes
    to the others by weight until none is above. That is the water level: ordered by limit / weight, the first
    sources that a common level would flood get their limit, the others weight * level.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on; windows over them are small.
    by_name = W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    choice = F.array(*(F.lit(float(w)) for w in weights))
    everything = W.partitionBy(F.lit(0))
    by_level = everything.orderBy("ratio", F.col("source").asc_nulls_last())
    lower = by_level.rowsBetween(W.unboundedPreceding, -1)
    ranked = (
        sizes.withColumn("weight", F.get(choice, (F.row_number().over(by_name) - 1) % len(weights)))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("cap_below", F.coalesce(F.sum("cap").over(lower), F.lit(0.0)))
        .withColumn("weight_below", F.coalesce(F.sum("weight").over(lower), F.lit(0.0)))
        .withColumn("weight_all", F.sum("weight").over(everything))
        .withColumn("level", (F.col("budget") - F.col("cap_below")) / (F.col("weight_all") - F.col("weight_below")))
        .withColumn("open_level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything))
    )
    open_level = F.col("open_level.level")
    target = F.when(open_level.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("weight") * open_level))
    return ranked.select("source", "source_size", target.alias("target"))


def _thresholds(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source (code `sid`) the hash point below which documents are taken once more.

    Each level sums sizes by bucket of the current range, finds the last bucket border within the goal, and the
    next level splits only the bucket at that border. Finally the border that is nearer to the goal is taken.
    """
    edge = goals.select("sid", F.col("goal"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("below"))
    for level in range(LEVELS):
        width = 1 << ((LEVELS - 1 - level) * LEVEL_BITS)
        bucket = F.floor(F.col("point") / F.lit(width)).cast("long")
        inside = sized.join(F.broadcast(edge.select("sid", "start")), "sid").where(
            (F.col("point") >= F.col("start")) & (F.col("point") < F.col("start") + (width << LEVEL_BITS))
        )
        sums = inside.groupBy("sid", bucket.alias("bucket")).agg(F.sum("size").alias("amount"))
        up_to = W.partitionBy("sid").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
        run = (
            sums.withColumn("upto", F.sum("amount").over(up_to))
            .join(F.broadcast(edge.select("sid", "goal", "below")), "sid")
            .withColumn("upto", F.col("upto") + F.col("below"))
            .where(F.col("upto") > F.col("goal"))
            .groupBy("sid")
            .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("amount")).alias("below"), "upto")).alias("hit"))
        )
        # A source whose documents do not reach the goal has no boundary bucket: all are taken.
        edge = edge.select("sid", "goal").join(run, "sid", "left").select(
            "sid", "goal", F.coalesce(F.col("hit.bucket") * width, F.lit(_TOP)).alias("start"),
            F.coalesce(F.col("hit.below"), F.lit(0)).alias("below"), F.col("hit.upto").alias("upto"),
        )
        edge = stage(edge)
    over = F.col("upto") - F.col("goal")
    nearer = F.when(over < F.col("goal") - F.col("below"), F.col("start") + 1).otherwise(F.col("start"))
    return edge.select("sid", nearer.alias("threshold"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    most: float = 2.0,
    carry: Sequence[str] = (),
) -> DataFrame:
    """How many words of each document the mix takes: id, size, source, source_size, target, taken.

    A source's target divided by its size gives whole passes over it and a rest. Every document is taken once a pass,
    and once more if its hash point lies under the source's threshold for the rest, so no document is
    taken more than ceil(target / source size) times. The threshold comes from nested histograms of sizes by
    hash bucket; nothing is sorted. Points depend on the id only, so reruns agree and rows with the same id in one
    source stand or fall together; rows without an id share one point. Null texts have size 0; a null source is a source
    of its own. Sources without words get target 0. An empty table gives an empty result. Columns named in `carry`
    are added to their rows.

    The number of sources must be small enough for one row each in a broadcast; documents per source are not bounded.
    """
    plain = docs.select(F.col(f"`{id_col}`").alias("id"), word_count(F.col(f"`{text_col}`")).alias("size"),
                        F.col(f"`{source_col}`").alias("source"), *(F.col(f"`{c}`") for c in carry))
    # Words are counted once; the histograms then read a few bytes a document.
    counted = stage(plain.withColumn("point", hash_point(F.col("id"))))
    names = source_targets(counted, weights, share, most)
    by_name = W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    targets = stage(names.withColumn("sid", F.row_number().over(by_name)))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("passes", passes).withColumn("goal", F.col("target") - F.col("passes") * F.col("source_size"))
    same = F.col("d.source").eqNullSafe(F.col("t.source"))
    sized = counted.alias("d").join(F.broadcast(targets.alias("t")), same).select(
        "id", "size", "d.source", "source_size", "target", "passes", "sid", "point", *carry
    )
    limits = _thresholds(sized, targets)
    more = F.when(F.col("point") < F.col("threshold"), F.lit(1)).otherwise(F.lit(0))
    copies = (F.col("passes") + more).cast("long")
    return sized.join(F.broadcast(limits), "sid").select(
        F.col("id").alias(id_col), "size", "source", "source_size", "target",
        (F.col("size") * copies).alias("taken"), copies.alias("copies"), *carry,
    )
