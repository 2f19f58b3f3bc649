"""DataFrame -> DataFrame operators and thin builders over ``pyspark.ml``."""
