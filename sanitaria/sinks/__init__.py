"""Writers: the store, the manifest and exports."""
