"""DataFrame-to-DataFrame operators on records, rules and triples."""
