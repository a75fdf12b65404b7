"""Point-in-time analytics on event and game data, as Spark jobs."""
