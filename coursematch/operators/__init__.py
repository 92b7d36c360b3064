"""General table operators, usable on any DataFrame (column names are arguments)."""

from coursematch.operators.joins import overlap_join, overlaps, wildcard_join, wildcard_matches
from coursematch.operators.ranges import keep_shown, previous_value, running_sum
from coursematch.operators.versions import current_or_future, latest_version
from coursematch.operators.windows import dedupe_by_key, lag_marker, running_cutoff, top1

__all__ = ["overlap_join", "overlaps", "wildcard_join", "wildcard_matches", "current_or_future", "latest_version",
           "dedupe_by_key", "lag_marker", "running_cutoff", "top1", "keep_shown", "previous_value", "running_sum"]
