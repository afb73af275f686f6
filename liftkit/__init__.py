"""liftkit: marketing incrementality measurement as Spark DataFrame jobs."""
