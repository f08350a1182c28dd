"""skein sources."""
