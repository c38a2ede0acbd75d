"""Runnable jobs over given tables; each module has a function that takes a session, a command line and a config file beside it."""
