"""Registered record systems."""

from sanitaria.systems.base import REGISTRY, System, ViewSpec, get_system, register, system_names
from sanitaria.systems.death import DEATH
from sanitaria.systems.hospital import HOSPITAL

__all__ = ["DEATH", "HOSPITAL", "REGISTRY", "System", "ViewSpec", "get_system", "register", "system_names"]
