"""Order, stock and customer event analytics as plain Spark DataFrame functions.

Every operator is a function from DataFrames to a DataFrame and runs unchanged
on a batch table or, where the semantics allow it, on a stream.
"""
