"""Running queries, sinks and state inspection."""
