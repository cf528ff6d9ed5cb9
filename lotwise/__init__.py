"""Market intelligence for vehicle listings, as Spark DataFrame operators."""
