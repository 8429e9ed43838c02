"""An extension: new target files linked as they arrive.

Key rows of source 1 and key frequencies come from tables that the last batch run wrote, so
each micro-batch joins only its own keys. Counts of target keys are those of that snapshot plus
the micro-batch; a batch run later corrects what a stale count let through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import text as X
from ..operators import blocking


def new_candidates(left_keys: DataFrame, target_counts: DataFrame, batch: DataFrame, settings: S.Settings = S.DEFAULT) -> DataFrame:
    """Candidate pairs of a micro-batch of raw target rows, ranked within it."""
    keys = blocking.keyed(X.normalised(batch), settings)
    counts = target_counts.select("rule", "key", "n").union(blocking.frequencies(keys)).groupBy("rule", "key").agg(F.sum("n").alias("n"))
    live = counts.where((F.col("n") >= 1) & (F.col("n") <= blocking._cap("right"))).select("rule", "key")
    return blocking.chosen(left_keys, keys.join(live, ["rule", "key"], "left_semi"), settings.top)


def start(stream: DataFrame, left_keys: DataFrame, target_counts: DataFrame, out: str, checkpoint: str, settings: S.Settings = S.DEFAULT):
    """Runs over a stream of target rows; each batch overwrites its own folder, so a batch that
    is run again after a failure leaves no pair twice."""

    def each(batch: DataFrame, number: int) -> None:
        new_candidates(left_keys, target_counts, batch, settings).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
