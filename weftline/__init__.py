"""weftline: a Spark-first engine for the data work behind tool-using language models."""
