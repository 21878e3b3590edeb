"""Wire formats of row changes as column expressions over a change DataFrame."""
