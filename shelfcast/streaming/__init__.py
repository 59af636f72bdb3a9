"""The weekly arrival cycle as Structured Streaming."""
