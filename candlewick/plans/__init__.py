from candlewick.plans import bronze, build, gold, landing, silver

__all__ = ["bronze", "build", "gold", "landing", "silver"]
