"""Writers: shards, manifests, info files."""
