"""Column functions: text search, scalars, and the HTML helper used inside tasks."""
