"""DataFrame operators. Those in ``windows`` and ``latest`` take static and streaming frames alike."""
