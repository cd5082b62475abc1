"""Column -> Column helpers; everything stays in built-in Spark expressions."""
