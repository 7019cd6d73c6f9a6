"""Query plans: conformed build, semantic model, analyses, governance."""
