"""Operators that prepare text corpora for training: de-duplication, filters, mixing, sharding.

Nothing else in the library imports this subpackage. Operators take a DataFrame with at least the columns
they name and ignore all others, so extra columns may have any name. Intermediate tables go below the folder
that the session names in ``spark.checkpoint.dir``, so a lost executor costs a stage, not the job.
"""
