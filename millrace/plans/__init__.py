"""Query plans. Only the wiring query so far."""
