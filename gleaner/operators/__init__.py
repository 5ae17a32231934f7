"""DataFrame operators: extraction, papers, heuristics, validation, promotion, healing."""
