"""Document search by element terms and a word."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions.text import any_has, has_word


def search(
    documents: DataFrame,
    elements: str,
    field: str,
    terms: list[str],
    text: str,
    word: str,
) -> DataFrame:
    """Documents whose array ``elements`` holds every term and whose ``text`` has ``word``.

    Each term may be met by another element of the array, as in an index that
    flattens it.
    """
    found = has_word(F.col(text), word)
    for term in terms:
        found = found & any_has(F.col(elements), field, term)
    return documents.filter(found)
