"""Column -> Column expressions shared by all jobs."""
