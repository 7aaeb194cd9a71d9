"""Script jobs, the copy job, fixtures and the registered queries."""
