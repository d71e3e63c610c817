"""Column expressions: money, clocks and webhook signatures."""
