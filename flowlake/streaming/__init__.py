"""Row-wise operators on streams."""
