"""Column functions: text, rules, time, JSON variants, HTML and feed dates."""
