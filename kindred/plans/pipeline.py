"""The linkage pipeline: normalise, block, refine, score, decide."""

from __future__ import annotations

from collections.abc import Sequence
from copy import copy
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kindred.functions import fixed
from kindred.operators import blockwise, features, model, normalize, refine


@dataclass(frozen=True)
class LinkageConfig:
    strategies: Sequence[str] = field(default_factory=lambda: list(fixed.STRATEGIES))
    max_block_size: int = fixed.MAX_BLOCK_SIZE
    score_threshold: float = fixed.SCORE_THRESHOLD
    top_k: int = fixed.TOP_K
    match_threshold: float = fixed.MATCH_THRESHOLD


class LinkagePipeline:
    """Links anchors with targets. Both are entities: entity_id, business_name, business_address, country, seq.

    Countries are part of every key, so one global join takes the place of a loop over countries. Normalised texts are
    read for keys, scores and features; they are kept in memory and on disk between these reads unless persist is
    False, and are worked out anew where an executor is lost. Views made of them are not kept: they are many times
    larger.
    """

    def __init__(self, anchors: DataFrame, targets: DataFrame, config: LinkageConfig | None = None, persist: bool = True) -> None:
        self.config = config or LinkageConfig()
        self._kept: list[DataFrame] = []
        self.anchors, self.targets = self._normalized(anchors, persist, True), self._normalized(targets, persist, False)

    def _normalized(self, entities: DataFrame, persist: bool, is_query: bool) -> DataFrame:
        texts = normalize.texts(entities)
        if persist:  # with the keys of blocks, which are read twice
            texts = normalize.views(texts, texts.columns, {blockwise.KEPT: blockwise.kept_keys(is_query)})
            self._kept.append(texts.persist(StorageLevel.MEMORY_AND_DISK))
        return normalize.views(texts)

    def of_anchors(self, anchors: DataFrame) -> LinkagePipeline:
        """The same targets, normalised as they are, for other anchors."""
        out = copy(self)
        out._kept = []
        out.anchors = out._normalized(anchors, True, True)
        return out

    def close(self) -> None:
        """Frees what this pipeline keeps; of one made by of_anchors, its anchors alone."""
        for x in self._kept:
            x.unpersist()

    def raw_pairs(self) -> DataFrame:
        return blockwise.pairs(self.anchors, self.targets, self.config.strategies, self.config.max_block_size)

    def scored_pairs(self) -> DataFrame:
        """raw_pairs with score, before the threshold and the cut."""
        return blockwise.scored_pairs(self.anchors, self.targets, self.config.strategies, self.config.max_block_size)

    def candidates(self) -> DataFrame:
        c = self.config
        best = blockwise.scored_pairs(self.anchors, self.targets, c.strategies, c.max_block_size, c.top_k, c.score_threshold)
        return refine.top_k(best, c.top_k, c.score_threshold)

    def features(self, store: features.FrequencyStore | None = None, pairs: DataFrame | None = None, columns: Sequence[str] = fixed.FEATURES) -> DataFrame:
        """Features of pairs or else of all candidates; columns: of candidates, those alone are worked out."""
        if pairs is not None:
            return features.pair_features(pairs, self.anchors, self.targets, store)
        c = self.config
        return features.candidate_features(self.anchors, self.targets, c.strategies, c.max_block_size, c.top_k, c.score_threshold, store, columns)

    def matches(self, fitted: PipelineModel, store: features.FrequencyStore | None = None) -> DataFrame:
        """s1_id, target_id, prob of pairs whose probability reaches the threshold; an anchor may have any number."""
        scored = model.predict(fitted, self.features(store))
        return scored.filter(F.col("prob") >= self.config.match_threshold).select(F.col("source1_entity_id").alias("s1_id"), F.col("target_entity_id").alias("target_id"), "prob")

    def candidate_lists(self) -> DataFrame:
        return refine.per_anchor(self.anchors, self.candidates(), "candidate_entity_ids")

    def match_lists(self, fitted: PipelineModel, store: features.FrequencyStore | None = None) -> DataFrame:
        return refine.per_anchor(self.anchors, self.matches(fitted, store), "matched_entity_ids")


def one_anchor_per_target(matches: DataFrame) -> DataFrame:
    """Keeps each target's most probable anchor (ties to the smaller id): for sources where a target has one anchor."""
    best = Window.partitionBy("target_id").orderBy(F.desc("prob"), "s1_id")
    return matches.withColumn("__k", F.row_number().over(best)).filter(F.col("__k") == 1).drop("__k")
