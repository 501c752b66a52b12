"""View compositions, request planning and refresh."""
