"""Customer-engagement analytics on Spark DataFrames and streams.

Every operator is a plain function from DataFrame to DataFrame; nothing runs
until the caller acts on the result, except model fits, sinks and durable cuts.
"""
