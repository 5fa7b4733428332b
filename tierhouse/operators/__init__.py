"""Operators: frame in, frame out."""

from .key_maps import KeyMap
from .layout import (bytes_per_row, cluster, compact, compact_small, compaction_plan, file_summary, files_of,
                     rows_within, sized_for_write, with_curve_key, write_files)
from .lookups import HOT_ROWS, hot_keys, lookup, lookup_all
from .merging import delete_where, paired, scd1_upsert, scd2_apply_changes, scd2_merge, snapshot_diff
from .numbering import fill_keys, neighbours, next_value, surrogate_key
from .quality import (Rule, RuleViolation, amount_mismatches, apply_rules, dates_in_order, duplicate_keys, enforce,
                      expect, expect_or_drop, expect_or_fail, negative_amounts, null_counts, require_unique,
                      rule_report)
from .snapshots import (append_snapshot, append_snapshots, expired_versions, history, latest_number, read_as_of,
                        read_version, restore, version_as_of, versions)
from .staging import materialize, scratch_path, shared_folder
from .star import (conform, distinct_by_bitmap, group_counts, orphans, sales_summary, table_counts, top_groups, with_dimension_keys,
                   without_orphans)
from .versions import (current_rows, latest_version, range_conflicts, require_not_null, version_check, version_ranges,
                       versions_in_conflict, with_current_flag, with_open_version)
