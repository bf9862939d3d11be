"""Operators for preparing training text at scale, with their queries in ``corpusloom.llm.queries``."""
