from . import dates, scalars, semantics

__all__ = ["dates", "scalars", "semantics"]
