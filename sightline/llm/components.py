"""Connected components, for the operators of this package."""

from sightline.operators.components import components

__all__ = ["components"]
