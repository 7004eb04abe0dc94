"""Column expressions. None of them shuffles."""
