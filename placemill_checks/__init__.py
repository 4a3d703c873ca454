"""Input views derived from the test tables, the checked queries over them, and their independent SQL."""
