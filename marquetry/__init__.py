"""DataFrame operators and jobs for everyday data work on Spark."""
