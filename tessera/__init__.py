"""tessera: a Spark-first engine for building and querying a multi-resolution vector-map database."""
