"""Training-data operators: scoring, filtering, mixing, deduplication and token output of a text corpus.

Nothing outside this package imports it. Each module holds one operator with a general interface;
``queries`` derives the registered result tables from them. Functions that run inside tasks are sent
to the executors by value, so these need not have the package installed.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
