"""Schedule feeds from archives or folders, and realtime messages from files or the web."""
