"""tessera: text, table, graph, learning and event-stream operators as PySpark DataFrame functions.

Every public operator takes DataFrames (and plain parameters) and returns a DataFrame.
Nothing is collected to the driver; iterative jobs cut lineage with reliable checkpoints
under the session's ``spark.checkpoint.dir``.
"""

__version__ = "0.1.0"
