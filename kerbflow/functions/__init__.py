"""Column functions; all of them expand to built-in Spark expressions."""
