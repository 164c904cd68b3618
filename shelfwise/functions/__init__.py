"""Column-expression helpers; all JVM-side, no Python UDFs."""

from shelfwise.functions.lists import books_text, first_id, recs_from_text, scores_text
from shelfwise.functions.split import hash_bucket, key_string, train_flag
from shelfwise.functions.vectors import dot, sq_dist

__all__ = [
    "books_text",
    "dot",
    "first_id",
    "hash_bucket",
    "key_string",
    "recs_from_text",
    "scores_text",
    "sq_dist",
    "train_flag",
]
