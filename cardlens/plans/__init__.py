"""Physical layout helpers and plan inspection."""
