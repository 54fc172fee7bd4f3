"""landfall: border-admission extracts to a star schema, as Spark DataFrames.

``sources`` read, ``functions`` and ``operators`` transform, ``plans`` build the
star tables and answer questions over them, ``sinks`` write, ``streaming`` keeps
the written tables current.  Transformations are lazy; only writers, the
lookup-size check and the month listing start a job.
"""
