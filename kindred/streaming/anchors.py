"""New anchors as a stream against a static set of targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from kindred.plans.pipeline import LinkageConfig, LinkagePipeline


def link_stream(anchors: DataFrame, targets: DataFrame, path: str, checkpoint: str, config: LinkageConfig | None = None) -> StreamingQuery:
    """Writes the candidates of each micro-batch of anchors. An anchor's best K depend on no other anchor, so no state
    is kept; a batch that is repeated overwrites its own folder."""

    known = LinkagePipeline(targets.limit(0), targets, config)  # targets are normalised once for all batches

    def write(batch: DataFrame, number: int) -> None:
        p = known.of_anchors(batch)
        try:
            p.candidates().select("s1_id", "target_id", "strategies", "score", "rank").write.mode("overwrite").parquet(f"{path}/batch={number}")
        finally:
            p.close()

    return anchors.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
