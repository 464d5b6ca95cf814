"""Row operators: look-up joins, cleaning, upserts, versioning, fact assembly."""
