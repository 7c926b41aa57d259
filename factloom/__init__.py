"""Evidence fusion, entity resolution and reporting as PySpark DataFrame plans."""
