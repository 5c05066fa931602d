"""Multi-stage jobs: each stage reads tables, writes tables, and passes only names and counts on."""
