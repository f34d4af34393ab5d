"""Sorted frames whose rows carry their place (the library's general helpers)."""

from kestrel.functions.ordering import PART_SHIFT, dense_positions, partition_starts, sorted_ids

__all__ = ["PART_SHIFT", "dense_positions", "partition_starts", "sorted_ids"]
