"""Training-data operators: ten Spark jobs over the text tables, and their registered queries."""
