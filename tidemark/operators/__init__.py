"""DataFrame-to-DataFrame operators, usable on batch and streaming frames alike."""
