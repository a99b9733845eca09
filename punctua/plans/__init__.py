"""Tables and documents of the platform, each a plan built from the operators."""
