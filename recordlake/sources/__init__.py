"""Sources (S1-S9) and sinks (K1-K6)."""
