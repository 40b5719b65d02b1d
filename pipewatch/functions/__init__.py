"""Column expressions: scalars, log text, schedules."""
