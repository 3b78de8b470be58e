"""Balance attribution and reward analytics as Spark DataFrame transformations."""
