"""Jobs: the operators put together."""
