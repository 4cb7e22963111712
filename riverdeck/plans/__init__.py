"""Reusable plan shapes: range-sliced ordered work, paging, bounded lists, one-row frames."""
