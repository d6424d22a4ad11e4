"""The questions a user asks, each put together from the operators."""
