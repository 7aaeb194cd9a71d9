"""DataFrame operators: envelopes, changelogs, routing, allocation."""
