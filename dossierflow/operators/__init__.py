"""DataFrame -> DataFrame jobs, one module per group of operators."""
