"""Operations of a training-data pipeline: cleaning, near duplicates, mixing, scoring, search.

Nothing outside this package imports it. Every operator takes and returns DataFrames; what Spark's
functions cannot express runs on Arrow batches inside tasks.
"""
