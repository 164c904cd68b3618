"""Operators: features, factor models, clusters, evaluation, model registry."""
