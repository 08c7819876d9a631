"""Operators composed into the jobs a user runs; each is one lazy DataFrame plan."""
