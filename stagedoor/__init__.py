"""Sales, attribution and attendance analytics as Spark DataFrame transformations."""
