"""Column functions: lenient text handling, sequence arithmetic and test statistics."""
