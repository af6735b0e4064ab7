"""Models and jobs composed from the operators."""
