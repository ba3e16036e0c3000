"""The test tables bound to the operators, each query beside its SQL check."""

from importlib import import_module
from types import ModuleType

MODULES = ("scalars", "cleaning", "batch", "runs", "serving", "streams")


def load() -> ModuleType:
    """Import every module that registers queries; the register comes back."""
    for name in MODULES:
        import_module(f"tallyline.bindings.{name}")
    return import_module("tallyline.bindings.registry")
