"""Jobs: operators composed over stored tables, returning small results."""
