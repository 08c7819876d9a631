"""Property-valuation analytics on Spark DataFrames.

Layers, lowest first: ``functions`` (Column -> Column), ``sources`` (files and payload
columns -> DataFrame), ``operators`` (DataFrame -> DataFrame), ``plans`` (operators composed
into the jobs a user runs), ``streaming`` (the same work fed incrementally) and ``catalog``
(every operator run on the driver tables, next to its SQL form).
"""
