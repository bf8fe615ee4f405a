"""DataFrame-to-DataFrame operators, composed with ``DataFrame.transform``."""
