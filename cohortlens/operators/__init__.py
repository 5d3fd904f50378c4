"""DataFrame -> DataFrame operators of the toolkit."""
