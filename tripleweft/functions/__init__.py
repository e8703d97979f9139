"""Column builders: templates, paths, escaping and names."""
