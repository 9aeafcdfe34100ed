"""The event feeds as Structured Streaming queries."""
