"""tessera: a Spark-native engine for question/answer corpora.

Corpus preparation, tokenizer training, sequence packing, n-gram language
modelling, decoding over score tables and run-log analysis, each expressed as
DataFrame jobs (joins, aggregates, windows) that Catalyst plans and Spark
partitions.
"""

from tessera.config import Config  # noqa: F401

__all__ = ["Config"]
