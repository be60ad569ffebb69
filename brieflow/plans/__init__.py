"""Composed plans: the briefing pipeline and the registered query catalog."""
