"""Plan-level helpers: sizes, skew, scratch folders and the composed job."""
