"""Training-data operators: near-duplicate search, line and substring
de-duplication, sharding, decontamination, token accounting, quality scoring,
secret scanning and sequence packing.

Each module is one operator with a general DataFrame interface; ``queries``
registers one query per operator over the whole tables. Nothing else in the
library imports this subpackage.
"""
