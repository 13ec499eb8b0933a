"""Column-level building blocks: text repair, naming and small reports."""
