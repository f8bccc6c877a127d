"""DataFrame-to-DataFrame operators over channel tables and profiles."""
