"""Column functions."""

from kindred.functions.text import common_prefix, common_suffix, edit_similarity, fold_accents, grams, has_non_latin, jaccard

__all__ = ["common_prefix", "common_suffix", "edit_similarity", "fold_accents", "grams", "has_non_latin", "jaccard"]
