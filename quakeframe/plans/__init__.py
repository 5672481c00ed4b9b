"""Jobs and registered queries made of the operators."""
