"""Column functions: each takes and returns a Column and stays inside generated code."""
