"""Record linkage and corpus preparation as PySpark DataFrame transformations."""
