"""Column expressions. Nothing here runs a job; everything stays inside Spark's code generation
where Spark offers it."""
