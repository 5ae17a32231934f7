"""Column functions: text preparation, links, identifiers, similarity, healing."""
