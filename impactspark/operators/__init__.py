"""DataFrame -> DataFrame operators."""

from .aggregates import (count_rows, distinct_list_by_key, duplicate_rows, first_non_null,
                         first_non_null_cols, joined_distinct,
                         sorted_distinct, value_frequency)
from .dedup import (cross_source_repeats, drop_covered, drop_exact_duplicates, duplicate_members,
                    duplicate_report, highest_per_key, keep_first, keep_first_passes, key_violations,
                    latest_preferred)
from .frames import (all_but, column_gaps, drop_if_present, drop_null_all, drop_null_any,
                     in_window, preview, rename_positional, select_contract, sort_keys, sort_output, top_k,
                     union_all, worst)
from .joins import (Enriched, Identifier, align_full, enrich_checked, enrich_counted, enrich_tiers, fill_where, flag_members, fold_tiers,
                    left_chain, lookup_join, null_safe_join, remap_identity, resolve_identifiers, resolve_ids,
                    unmatched)
from .lookups import (field_lookup, join_map, map_frame, map_label, map_literal, merge_maps,
                      unmapped_values)
from .quality import (Check, ValidationError, gate, measured, observed, offenders, offenders_by_check,
                      per_key_diff, reconcile, row_hash, run_checks, split_drops, stage_checked)
from .reshape import (block_names, blocks_to_rows, count_lit, grid, interleave, pivot,
                      split_explode)
from .windows import count_once, rank_within, running_index

__all__ = [n for n in dir() if not n.startswith("_")]
