"""How work is spread: hot keys, skew-proof joins, ranks over huge groups, scratch tables."""
