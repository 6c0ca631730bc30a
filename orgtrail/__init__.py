"""Company-registry analytics as Spark DataFrame functions.

``sources`` reads and writes, ``functions`` builds Columns, ``operators`` reshapes
and joins DataFrames, ``plans`` assembles whole reports and ``jobs`` runs them.
``sources`` sinks and ``jobs`` start Spark actions; so do ``operators.sides.rest``, which
writes a join side once and measures it by that, and the summary of ``operators.joins.heavy_keys``.
"""
