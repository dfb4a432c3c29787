"""Gold tables, the jobs that write them, and the event generator."""
