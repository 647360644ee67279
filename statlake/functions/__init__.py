"""Column functions: ``Column -> Column``, all evaluated by Spark itself."""
