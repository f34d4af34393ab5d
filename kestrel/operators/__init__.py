"""DataFrame -> DataFrame operators."""

from kestrel.operators import kmeans, mentions, qa, sampling, survey

__all__ = ["kmeans", "mentions", "qa", "sampling", "survey"]
