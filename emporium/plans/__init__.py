"""Model plans: staging -> intermediate -> marts, each a lazy DataFrame function."""
