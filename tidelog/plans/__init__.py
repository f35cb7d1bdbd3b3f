"""Layer steps, jobs, many topics, reports."""
