"""Multi-operator jobs (checkout, cart view, assistant) and the query registry."""
