"""End-to-end plans: pages -> payloads -> processed records."""
