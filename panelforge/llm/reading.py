"""Places of lines and selected runs of words from one pass over all texts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelforge.llm import paragraphs, passages
from panelforge.llm.words import by_words
from panelforge.session import stage


def read(docs: DataFrame, similarity: float = paragraphs.SIMILARITY, least_words: int = paragraphs.LEAST_WORDS,
         run: int = passages.RUN, window: int = passages.WINDOW) -> tuple[DataFrame, DataFrame]:
    """What ``paragraphs.places`` and ``passages.runs`` give, staged; each text is split into words once."""
    bands, rows = paragraphs.bands_for(similarity)
    least = min(paragraphs.SHORT_WORDS, least_words)
    found = stage(by_words(docs, {**paragraphs.COLUMNS, **passages.COLUMNS}, lambda ids, words: [
        paragraphs.place_columns(ids, words, least, least_words, bands, rows), passages.run_columns(ids, words, run, window)]), "read")
    return (found.where("cls is not null").select("doc_id", *paragraphs.COLUMNS),
            found.where("key is not null").select("doc_id", *passages.COLUMNS))
