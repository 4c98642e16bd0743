"""The query library: every plan is a function from a view to its result."""

from sanitaria.plans import death, explore, hospital


def templates(system: str):
    """Named queries of a system; systems without their own share the hospital ones."""
    return dict(death.TEMPLATES if system.lower() == "sim" else hospital.TEMPLATES)


__all__ = ["death", "explore", "hospital", "templates"]
