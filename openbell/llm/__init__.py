"""Training-data operators: deduplication, filtering, packing and archives as Spark jobs.

Nothing else in the library imports this package; ``registry`` lists its queries.
"""
