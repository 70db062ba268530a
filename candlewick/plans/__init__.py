"""Composed pipelines (C1-C13): each is one lazy DataFrame plan."""
