"""All query modules; importing this fills the registry."""

from . import combining, figures, flows, science, selection  # noqa: F401
from .registry import REGISTRY, runner

__all__ = ["REGISTRY", "runner"]
