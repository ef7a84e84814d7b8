"""The two datasets and the jobs that keep their tables current."""
