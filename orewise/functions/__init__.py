"""Column functions: nothing here runs Python on the executors."""
