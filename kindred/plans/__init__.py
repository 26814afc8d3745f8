"""Plans that join the operators."""

from kindred.plans.pipeline import LinkageConfig, LinkagePipeline, one_anchor_per_target

__all__ = ["LinkageConfig", "LinkagePipeline", "one_anchor_per_target"]
