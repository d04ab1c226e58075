"""Where lines come from and where tables go."""
