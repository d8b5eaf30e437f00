"""Column expressions: money, exchange rates, cards, text, seeded choice."""
