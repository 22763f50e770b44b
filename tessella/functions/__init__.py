"""Column functions: text normalisation, identifiers, predicates."""
