"""Stages that wire the operators together and write the results."""
