from vitrine.plans.warehouse import MODELS, Warehouse

__all__ = ["MODELS", "Warehouse"]
