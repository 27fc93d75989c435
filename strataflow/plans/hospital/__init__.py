"""The hospital warehouse as a configuration of the generic operators."""
