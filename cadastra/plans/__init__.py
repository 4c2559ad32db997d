"""End-to-end queries composed from sources, functions and operators."""
