"""Named queries over the test tables, their oracle SQL, and the table catalogue."""
