"""DataFrame operators: everything here takes DataFrames and returns a lazy DataFrame."""
