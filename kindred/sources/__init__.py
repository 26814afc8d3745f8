"""Readers and writers."""

from kindred.sources.sinks import bundle, markdown, write_candidate_pairs, write_csv, write_ids, write_matches, write_profile, write_report, write_tsv
from kindred.sources.tables import count_rows, document_entities, numbered_in_order, parse_truth, read_entity_ids, read_lines, read_source, truth_violations

__all__ = ["bundle", "count_rows", "document_entities", "markdown", "numbered_in_order", "parse_truth", "read_entity_ids", "read_lines", "read_source", "truth_violations", "write_candidate_pairs", "write_csv", "write_ids", "write_matches", "write_profile", "write_report", "write_tsv"]
