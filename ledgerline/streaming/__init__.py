"""The polling cursor as Structured Streaming."""
