"""Predicates for document search."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_word(text: Column, word: str) -> Column:
    """True when ``word`` occurs as a whole word, case ignored.

    Words are runs of letters and digits of any script. A regular expression
    over the text avoids building the array of its words.
    """
    token = re.escape(word.lower())
    return F.lower(text).rlike(rf"(^|[^\p{{L}}\p{{N}}]){token}($|[^\p{{L}}\p{{N}}])")


def any_has(items: Column, field: str, value: str) -> Column:
    """True when any element of an array of structs has ``field == value``."""
    return F.exists(items, lambda item: item[field] == F.lit(value))
