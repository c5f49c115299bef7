"""DataFrame -> DataFrame operators of the scoring pipeline."""
