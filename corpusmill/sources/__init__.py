"""Reading landed files and stored pages, and writing results."""
