"""Query plans over the driver's tables and the registry that names them."""


def load_all():
    """Import every plan module (each registers its queries) and return
    ``(QUERIES, ORACLE)``."""
    import importlib

    for mod in ("star", "profile", "monitoring", "derived", "learning", "streams", "features_in_time", "guards"):
        importlib.import_module(f"contrail.plans.{mod}")
    from contrail.plans.catalog import ORACLE, QUERIES
    return QUERIES, ORACLE
