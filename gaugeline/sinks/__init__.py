"""Where results go. Each sink takes a batch DataFrame; ``dispatch`` attaches one to a stream."""
