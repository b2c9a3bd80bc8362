"""Column-expression builders.  Nothing here triggers a Spark job."""
