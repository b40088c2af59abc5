"""Product-review analytics expressed as Spark DataFrame transformations."""
