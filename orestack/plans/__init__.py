"""The bronze, silver and gold layers, the reports and the end-to-end run."""
