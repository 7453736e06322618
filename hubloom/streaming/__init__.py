"""Structured Streaming jobs. Each sink is a folder per batch that a repeated
batch overwrites, so a restart neither loses nor doubles rows."""
