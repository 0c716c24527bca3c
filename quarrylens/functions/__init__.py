"""Column-level building blocks: numbers, dates, predicates, aggregates, business rules."""
