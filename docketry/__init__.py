"""docketry: Spark-first analytics over partitioned archives of court records."""
