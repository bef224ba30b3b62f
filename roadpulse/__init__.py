"""Road-sensor series analytics written as Spark DataFrame functions."""
