"""Stage jobs: bronze, silver, gold, full run."""
