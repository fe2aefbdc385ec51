"""Security-log analytics on Spark: audit and syslog lines as DataFrames.

Every operator is a function ``f(df, ...) -> DataFrame`` (or a ``Column``
function) and runs unchanged on batch and streaming frames unless its
docstring says otherwise.
"""
