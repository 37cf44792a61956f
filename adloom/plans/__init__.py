"""Models put together from operators."""
