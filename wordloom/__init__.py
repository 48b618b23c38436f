"""wordloom: word and document representations computed as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

from wordloom.errors import DocumentNotInCollection, WordNotInVocabulary

__all__ = ["DocumentNotInCollection", "WordNotInVocabulary"]

# Functions of this package travel to the workers by value: only the driver needs it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
