"""Where data comes from and goes to: shards, staging, manifests, the aggregate."""
