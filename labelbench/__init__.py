"""Binary classification on tables, written as Spark DataFrame jobs."""
