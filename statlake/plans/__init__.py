"""Load planning and whole jobs."""
