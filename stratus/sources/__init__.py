"""Landing, bronze, export and replay."""
