"""vitrine: product-catalog analytics as Spark DataFrame jobs."""
