"""Vehicle-fleet warehouse jobs written as Spark DataFrame plans."""
