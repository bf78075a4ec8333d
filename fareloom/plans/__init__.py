"""Jobs: what is read, run and written, and in which order."""
