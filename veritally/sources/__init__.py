"""Reading landed records, writing column files, and named tables."""
