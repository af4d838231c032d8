"""Column functions: text, time, numbers and row-local lists. Built-ins only, no UDF."""
