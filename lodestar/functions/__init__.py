"""Column-in / Column-out functions (JVM-side expressions, no Python UDFs)."""

from lodestar.functions.scalar import (keep_probability, node_key, round_star, scaled_bid,
                                       trunc2, with_intercept)
from lodestar.functions.text import clean_word, tokenize, tokens
from lodestar.functions.vector import (cosine, dot, l2_normalize, mean_center, nan_to_zero, norm,
                                       pattern_similarity, scale)

__all__ = ["keep_probability", "node_key", "round_star", "scaled_bid", "trunc2", "with_intercept",
           "clean_word", "tokenize", "tokens", "cosine", "dot", "l2_normalize", "mean_center",
           "nan_to_zero", "norm", "pattern_similarity", "scale"]
