"""Connected components, as the splicing operators use them."""

from ..operators.components import connected_components

__all__ = ["connected_components"]
