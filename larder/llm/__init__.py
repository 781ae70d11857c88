"""Training-data operators: cleaning, deduplication, classifiers, packing.

Each module holds one operator with its own general interface and the thin
``query`` that applies it to a whole table. Nothing outside this subpackage
(except the guarded import in ``__spark_entry__``) uses it.
"""
