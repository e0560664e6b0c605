"""Column functions: every one maps Columns to a Column, with no Python in the workers."""
