"""Column expressions: time grid arithmetic, calendar, exact aggregates."""
