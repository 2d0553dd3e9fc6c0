"""Reports, export and the whole pipeline, composed from the operators."""
