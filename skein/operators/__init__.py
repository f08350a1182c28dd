"""skein operators."""
