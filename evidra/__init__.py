"""Evidence graphs on Spark: DataFrame operators that read, filter, join, assemble, audit and query evidence."""
