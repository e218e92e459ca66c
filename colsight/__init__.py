"""colsight: find out what large collections of tables hold, as Spark jobs."""
