"""Linkage operators."""

from kindred.operators.blocking import block_keys, block_pairs, block_sizes, candidate_pairs, retrieve, strategy_contribution
from kindred.operators.features import FrequencyStore, labelled, pair_features
from kindred.operators.metrics import average_precision, error_categories, evaluate_at_threshold, evaluate_candidate_blocking, evaluate_predictions, recall_ceilings, roc_auc, threshold_sweep
from kindred.operators.model import champion, load, predict, run_ablations, save, train
from kindred.operators.normalize import normalized
from kindred.operators.refine import empty_candidates, pair_scores, per_anchor, top_k
from kindred.operators.split import split_by_hash, split_by_shuffle, with_distractors
from kindred.operators.validate import check_headers, violations

__all__ = ["FrequencyStore", "average_precision", "block_keys", "block_pairs", "block_sizes", "candidate_pairs", "champion", "check_headers", "empty_candidates", "error_categories", "evaluate_at_threshold", "evaluate_candidate_blocking", "evaluate_predictions", "labelled", "load", "normalized", "pair_features", "pair_scores", "per_anchor", "predict", "recall_ceilings", "retrieve", "roc_auc", "run_ablations", "save", "split_by_hash", "split_by_shuffle", "strategy_contribution", "threshold_sweep", "top_k", "train", "violations", "with_distractors"]
