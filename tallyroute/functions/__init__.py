"""Column-level building blocks: cleaning, dates, durations, payloads, rules, fixed values."""
