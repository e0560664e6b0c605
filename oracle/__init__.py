"""Independent SQL for the registered queries."""
