"""The state of a table at many positions of its change log, in one pass over the log.

Every row image holds from its own position until the next change of its key: an interval of
positions. A list of moments meets the intervals by an equality on bins of positions, as many
bins as moments, so a moment is compared only with the intervals that reach its bin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from proofline.functions.predicates import whole_blocks
from proofline.sources.changelog import DELETE
from proofline.streaming.apply import APPLIED, BLOCK, judge


def validity(base: DataFrame, changes: DataFrame, keys: list[str], columns: list[str], block: int = BLOCK) -> DataFrame:
    """Rows (keys, columns, seq, until): each image and the position from which it no longer holds, NULL for open ones.

    Only applied changes count. A hot key's images are followed inside blocks of positions, and
    the last image of a block asks the first one of the key's next block, so no task takes all
    changes of a key.
    """
    judged = judge(changes, base, keys, block=block).where(F.col("verdict") == APPLIED)
    images = base.select(*keys, *columns, "seq", F.lit(False).alias("_gone")).unionByName(
        judged.select(*keys, *columns, "seq", (F.col("op") == DELETE).alias("_gone"))
    )
    images = images.withColumn("_block", whole_blocks(F.col("seq"), block))
    inside = Window.partitionBy(*keys, "_block").orderBy("seq")
    followed = images.withColumn("_next", F.lead("seq").over(inside))
    firsts = images.groupBy(*keys, "_block").agg(F.min("seq").alias("_first"))
    later = firsts.withColumn("_later", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_block"))).drop("_first")
    until = F.coalesce("_next", "_later")
    return followed.join(later, [*keys, "_block"]).where(~F.col("_gone")).select(*keys, *columns, "seq", until.alias("until"))


def as_of_many(base: DataFrame, changes: DataFrame, keys: list[str], columns: list[str], moments: list[int], block: int = BLOCK) -> DataFrame:
    """(at_seq, keys, columns, seq): the rows of the table after each of the given positions.

    The moments are a list the caller holds; repeated ones count once. An interval is copied to
    the bins it reaches between the first and the last moment, at most as many as there are
    moments, and meets the few moments of each bin.
    """
    at = sorted(set(moments))
    held = validity(base, changes, keys, columns, block)
    low, high = (at[0], at[-1]) if at else (0, -1)
    width = max(1, -(-(high - low + 1) // max(1, len(at))))
    bins = held.sparkSession.createDataFrame([((m - low) // width, m) for m in at], "_bin long, at_seq long")
    held = held.where((F.col("seq") <= high) & (F.col("until").isNull() | (F.col("until") > low)))
    place = lambda c: whole_blocks(F.greatest(c, F.lit(low)) - low, width)
    last = F.least(F.coalesce(F.col("until") - 1, F.lit(high)), F.lit(high))
    spread = held.withColumn("_bin", F.explode(F.sequence(place(F.col("seq")), place(last))))
    inside = (spread["_bin"] == bins["_bin"]) & (F.col("at_seq") >= F.col("seq")) & (F.col("until").isNull() | (F.col("at_seq") < F.col("until")))
    return spread.join(F.broadcast(bins), inside).select("at_seq", *keys, *columns, "seq")
