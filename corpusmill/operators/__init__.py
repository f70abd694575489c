"""DataFrame -> DataFrame operators: quality, labelling, review, alignment, learning."""
