"""Typed errors raised by single-item lookups."""


class WordNotInVocabulary(KeyError):
    """The word never occurred, or occurred less often than ``min_count``."""


class DocumentNotInCollection(KeyError):
    """The document is not one of those the matrix was counted over."""
