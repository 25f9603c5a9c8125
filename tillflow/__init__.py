"""tillflow: retail stream analytics as plain Spark DataFrame functions.

Every operator takes DataFrames and returns a DataFrame. Operators without
state accept batch and streaming frames alike; operators with state come as a
batch form in ``operators`` and a Structured Streaming form in ``streaming``.
"""
