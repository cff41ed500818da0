"""Hotel booking analytics as Spark DataFrame transformations."""
