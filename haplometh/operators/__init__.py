"""Table operators: ``DataFrame`` in, ``DataFrame`` out, no Spark action inside."""
