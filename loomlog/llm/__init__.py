"""Operators for training-data pipelines over ``documents``-like tables.

Nothing outside this package imports it.  Shared conventions:

* inputs are DataFrames; an operator selects the columns it is told to use, so
  extra columns (whatever their names) neither clash nor move;
* the work is partitioned by Spark; Python runs inside tasks on Arrow batches
  (numpy over UTF-8 bytes), a bounded slice of text at a time;
* tables an operator needs twice are written under ``spark.checkpoint.dir``
  (``loomlog.session.scratch_path``), so a lost executor costs a re-read.
"""
