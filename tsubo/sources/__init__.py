"""Sources, sinks and the written stages between long jobs."""
