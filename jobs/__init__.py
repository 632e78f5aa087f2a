"""Runnable jobs: a function that takes a session, a command line and a small configuration file each."""
