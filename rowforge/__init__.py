"""rowforge: DataFrame and Structured Streaming operators for turning dirty
delimited files and message streams into clean, joined and summarised tables.

Every operator is a function from DataFrame(s) to DataFrame built from Spark's
own expressions, so Catalyst sees the whole plan (pushdown, pruning, codegen).
"""

__version__ = "0.1.0"
