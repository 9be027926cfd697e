"""DataFrame-to-DataFrame operators: staging, identity, upsert, mart, profile, quality."""
