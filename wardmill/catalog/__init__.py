from wardmill.catalog.base import REGISTRY, Entry


def registry() -> dict[str, Entry]:
    """All registered queries, loading the modules that define them."""
    from wardmill.catalog import derived, extracts, maternal, programs, records, relational, temporal, wide  # noqa: F401, I001
    from wardmill.catalog import lookups  # noqa: F401

    return REGISTRY
