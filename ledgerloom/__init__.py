"""Back-office analytics operators expressed as Spark DataFrame transformations."""
